"""Spelling variants: words one edit from a much more frequent word, by pivotal grams.

A word is indexed by its rarest bigrams (its prefix) and looked up by two disjoint ones of
these (its pivots). One edit spoils at most one of two disjoint bigrams and moves the
other by at most one place, so of two near words the one whose prefix ends earlier in the
order of rarity has a pivot within the other's prefix.
"""

from __future__ import annotations

import collections
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import frames
from barloom.sources.scratch import materialize

#: Letters after A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")

#: A word's prefix is this many bigrams (two a possible edit, and one), and ties of the last.
PREFIX = 3
#: A word of fewer code points has no two disjoint bigrams in its prefix.
SHORTEST = PREFIX + 1
#: Bigrams are weighed by the words in their bucket, so what reaches the tasks has a fixed size whatever the alphabet.
BUCKETS = 1 << 16


@dataclass(frozen=True)
class Rule:
    """Words of ``least_chars`` code points found ``least_count`` times; a form is ``ratio`` times as frequent."""

    least_chars: int = 5
    least_count: int = 3
    ratio: int = 2

    def __post_init__(self):
        if self.least_chars < SHORTEST:
            raise ValueError(f"words of under {SHORTEST} code points have no pivots")
        if self.ratio < 2:
            raise ValueError("forms of a ratio under 2 may go round in circles")


def lower(text: str) -> str:
    """A-Z as a-z; other letters stay."""
    return text.encode().lower().decode()


def count_words(
    df: DataFrame,
    rule: Rule = Rule(),
    doc_id: str = "doc_id",
    text: str = "text",
    spell: Callable[[str], Callable[[str], str]] | None = None,
) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z as a-z, long and frequent enough.

    ``spell`` may give, for a document's id as text (empty if null), a function from a run to the word counted
    in its place. Runs are counted per text, then per slice of texts, then per task, so a
    word that makes up a third of all text sends a row per task. A null text has none.
    """

    def start():
        def work(ids, bodies):
            counted = collections.Counter()
            for one, body in zip(ids, bodies):
                runs = collections.Counter(RUN.findall(lower(body)))
                if spell is None:
                    counted.update(runs)
                else:
                    change = spell(one or "")
                    for run, n in runs.items():
                        counted[change(run)] += n
            yield from ((word, n) for word, n in counted.items() if len(word) >= rule.least_chars)

        return work

    source = df.select(frames.col(doc_id).cast("string").alias("id"), frames.col(text).alias("body"))
    source = source.where("body is not null")
    counted = frames.explode_rows(source, [F.col("id"), F.col("body")], start, {"word": "string", "n": "bigint"})
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rule.least_count)


def misspell(every: int) -> Callable[[str], Callable[[str], str]]:
    """For ``count_words``: one in ``every`` pairs of document and run, by CRC-32 of ``id:run``, loses a code point."""

    def of(doc_id: str) -> Callable[[str], str]:
        begun = zlib.crc32(f"{doc_id}:".encode())

        def change(run: str) -> str:
            code = zlib.crc32(run.encode(), begun)
            if code % every:
                return run
            at = code % len(run)
            return run[:at] + run[at + 1 :]

        return change

    return of


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def disjoint(weighed: list[tuple[str, int, int]], count: int = 2) -> list[tuple[str, int]]:
    """Of (gram, position, weight), the ``count`` bigrams sharing no letter whose weights add up to the least.

    By dynamic programming over positions: ``best[k]`` holds the least sum of k of the
    bigrams that end before the current one begins; ties go to the earlier positions.
    """
    weighed = sorted(weighed, key=lambda g: g[1])
    # found[k]: after each bigram in turn, (sum, chosen) of the best k of those so far
    found: list[list[tuple[int, list[tuple[str, int]]] | None]] = [[(0, [])] * (len(weighed) + 1)]
    for k in range(1, count + 1):
        row: list[tuple[int, list[tuple[str, int]]] | None] = [None]
        for i, (gram, at, weight) in enumerate(weighed):
            best = row[-1]
            before = i  # bigrams that share no letter with this one
            while before and weighed[before - 1][1] + 1 >= at:
                before -= 1
            if found[k - 1][before] is not None:
                total, chosen = found[k - 1][before]
                if best is None or total + weight < best[0]:
                    best = total + weight, [*chosen, (gram, at)]
            row.append(best)
        found.append(row)
    return found[count][-1][1]


def signature(word: str, weights: dict[int, int]) -> tuple[int, list[int], list[int]]:
    """(end of the prefix in the order of rarity, positions of the prefix' bigrams, positions of the pivots)."""
    grams = []
    for at in range(len(word) - 1):
        number = bucket(word[at : at + 2])
        weight = weights.get(number, 0)
        grams.append((weight * BUCKETS + number, at, weight))
    last = sorted(grams)[PREFIX - 1][0]
    prefix = [g for g in grams if g[0] <= last]
    pivots = disjoint([(word[at : at + 2], at, weight) for _, at, weight in prefix])
    return last, [at for _, at, _ in prefix], [at for _, at in pivots]


def places(word: str, positions: list[int], lengths: tuple[int, ...]) -> Iterator[int]:
    """Where bigrams are met by words of the given lengths: one number per bigram, side and length.

    If the edit is behind a bigram, all up to it is alike; if before it, all from it on. So the position
    limit is met by the letters themselves: a bigram's place is the word's beginning up to its end, or the
    word's end from its start, and a length.
    """
    for at in positions:
        for side in ("<" + word[: at + 2], ">" + word[at:]):
            for length in lengths:
                yield xxhash.xxh3_64_intdigest(f"{length}{side}") - 2**63


def parity(word: str) -> int:
    """Of 64 kinds of letters, which occur an odd number of times, as bits: one edit turns two at most."""
    bits = 0
    for letter in word:
        bits ^= 1 << (ord(letter) & 63)
    return bits - ((bits >> 63) << 64)


def _gram_weights(words: DataFrame) -> dict[int, int]:
    """Words per bucket of bigrams, counted over all words: ``BUCKETS`` numbers at most."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(at, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    counted = grams.groupBy((F.crc32("gram") % BUCKETS).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    return {row["bucket"]: row["n"] for row in counted.collect()}


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb) of all words (word, n) that differ by one inserted, deleted or replaced code point, a < b.

    ``words`` holds each word once, of ``SHORTEST`` code points or more. The lookup meets on
    the places of bigrams, each pivot at the places one edit can leave it; a place
    that very many words share is split by the skewed join. No list
    of a bigram's words is gathered. Each meeting is checked, by the letters' parities and then by edit distance.
    """
    weights = _gram_weights(words)

    def start():
        def work(all_words, counts) -> Iterator[tuple]:
            for word, n in zip(all_words, counts):
                last, prefix, pivots = signature(word, weights)
                size, bits = len(word), parity(word)
                for place in places(word, prefix, (size,)):
                    yield place, word, n, last, bits, False
                for place in places(word, pivots, (size - 1, size, size + 1)):
                    yield place, word, n, last, bits, True

        return work

    fields = {"place": "bigint", "word": "string", "n": "bigint", "last": "bigint", "bits": "bigint", "asks": "boolean"}
    index = materialize(frames.explode_rows(words, [F.col("word"), F.col("n")], start, fields), "grams")
    asking, held = (
        index.where("asks" if asks else "not asks").select(
            "place", *[F.col(old).alias(new + name) for old, new in (("word", ""), ("n", "n"), ("last", "last"), ("bits", "bits"))]
        )
        for asks, name in ((True, "x"), (False, "y"))
    )
    alike = "lastx <= lasty and bit_count(bitsx ^ bitsy) <= 2 and x <> y and levenshtein(x, y, 1) = 1"
    met = asking.join(held, "place").where(alike)
    first = F.col("x") < F.col("y")
    return met.select(
        F.least("x", "y").alias("a"), F.when(first, F.col("nx")).otherwise(F.col("ny")).alias("na"),
        F.greatest("x", "y").alias("b"), F.when(first, F.col("ny")).otherwise(F.col("nx")).alias("nb"),
    ).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last.

    A form is more frequent than its word by a factor of ``ratio``, so chains are short
    and have no loops; each round doubles the steps taken, and the last changes nothing.
    """
    at = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(after, "root", "left")
        step = materialize(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def variants(words: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of ``words`` (word, n), which holds each word once.

    ``n_near`` is the number of words one edit away, ``form`` the most frequent of them (of equal ones the
    first in code-point order) if it is at least ``ratio`` times as frequent as the word, else
    null, ``form_n`` its count, and ``root`` what one gets to by following forms. Null words and
    those under ``least_chars`` are left out; so is everything else on an empty table.
    """
    words = words.select("word", "n").where(F.length("word") >= rule.least_chars)
    words = materialize(words, "words")
    pairs = materialize(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.order") >= rule.ratio * F.col("n")
    formed = materialize(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.order")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
