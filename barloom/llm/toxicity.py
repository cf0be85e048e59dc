"""Toxicity by weak supervision.

Lexicon voters are words and word beginnings mined from labelled documents; pattern
voters look at how many and how dense they are, and at shouting. A generative model
estimates each voter's accuracy and the voters' correlations, and a linear classifier
is trained on its posterior labels. Scores use the text alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import frames

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
N_PATTERNS = 4
ASSAULT = re.compile(r"\b(?:you|du|tu|vous)(?:'re|\s+are|\s+bist|\s+es|\s+eres|\s+êtes)?\s+(?:\w+\s+)?$")


@dataclass(frozen=True)
class Rule:
    """Bounds of what is learned from: ``labelled`` documents at most, ``voters`` lexicon voters at most.

    Of more labelled documents those of least hash are used. A lexicon voter must occur
    in at least ``least`` and a ``share`` of the toxic ones, ``ratio`` times as often as in others.
    """

    labelled: int = 8_000
    voters: int = 128
    least: int = 3
    share: float = 0.004
    ratio: float = 5.0


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept for testing: a fifth, by the CRC of its id; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def terms(text: str) -> set[str]:
    """A document's words (with a leading '=') and word beginnings."""
    words = set(WORD.findall(text.lower()))
    found = {f"={w}" for w in words if len(w) > 2}
    for n in BEGINNINGS:
        found.update(w[:n] for w in words if len(w) >= n)
    return found


class Reader:
    """Counts lexicon terms in a text, and the patterns' measures."""

    def __init__(self, lexicon: list[str]):
        self.n = len(lexicon)
        self.machine = ahocorasick.Automaton()
        for k, term in enumerate(lexicon):
            key = term.removeprefix("=")
            own = self.machine.get(key, ()) + ((k, len(key), term[0] == "="),)
            self.machine.add_word(key, own)
        if lexicon:
            self.machine.make_automaton()

    def read(self, text: str) -> np.ndarray:
        """Counts of all terms, then: distinct words hit, share of words hit, shouting, address."""
        lower = text.lower()
        counts = np.zeros(self.n + N_PATTERNS, np.float32)
        places: dict[int, str] = {}
        for end, found in self.machine.iter(lower) if self.n else ():
            for k, length, whole in found:
                begin = end - length + 1
                if begin and lower[begin - 1].isalpha():
                    continue
                if whole and end + 1 < len(lower) and lower[end + 1].isalpha():
                    continue
                counts[k] += 1
                places.setdefault(begin, "")
        if places:
            hits = [WORD.match(lower, begin) for begin in places]
            counts[self.n] = len({m.group() for m in hits if m})
            counts[self.n + 1] = len(places) / (lower.count(" ") + lower.count("\n") + 1)
            counts[self.n + 3] = sum(ASSAULT.search(lower, max(0, b - 40), b) is not None for b in places)
        counts[self.n + 2] = text.count("!") / (len(text) + 1)
        return counts


def votes(counts: np.ndarray, n: int) -> np.ndarray:
    """Votes (1 toxic, -1 not, 0 none) of all voters on documents (rows of counts)."""
    lexicon = (counts[:, :n] > 0).astype(np.int8)
    distinct, dense, shout, address = counts[:, n : n + N_PATTERNS].T
    patterns = [
        np.where(distinct >= 2, 1, np.where(distinct == 0, -1, 0)),
        np.where(dense >= 0.01, 1, np.where(dense == 0, -1, 0)),
        np.where(shout >= 0.02, 1, 0),
        np.where(address >= 1, 1, 0),
    ]
    return np.column_stack([lexicon, *patterns]).astype(np.int8)


def label_model(held: np.ndarray, gold: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each row, chances of votes by class, and each voter's weight.

    ``held`` are the votes, ``gold`` the given labels (1, -1, 0 unknown), a voter like
    the others that starts as the most accurate. After a first fit, voters that agree
    beyond what their accuracies explain share their weight: each counts 1 over 1 plus
    its correlations with others given the class; then the model is fitted again.
    """
    every = np.column_stack([held, gold])
    n, k = every.shape
    shown = np.stack([every == v for v in (-1, 0, 1)]).astype(float)  # vote, row, voter
    posterior = np.clip(0.5 + 0.45 * gold, 0.05, 0.95).astype(float)
    weight = np.ones(k)

    def fit():
        nonlocal posterior
        for _ in range(rounds):
            yes = np.einsum("vrk,r->vk", shown, posterior) + 0.5
            no = np.einsum("vrk,r->vk", shown, 1 - posterior) + 0.5
            log = np.log(yes / yes.sum(0)) - np.log(no / no.sum(0))
            prior = (posterior.sum() + 1) / (n + 2)
            odds = math.log(prior / (1 - prior)) + np.einsum("vrk,vk->r", shown, log * weight)
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            moved = np.abs(new - posterior).max()
            posterior = new
            if moved < 1e-6:
                break
        return np.stack([no / no.sum(0), yes / yes.sum(0)])

    fit()
    # Classes are those given, if there are enough of them: a group of like voters can
    # win the first fit over to itself, and then no correlation would be left to see.
    known = gold != 0
    seen, sure = (known, gold[known] > 0) if known.sum() >= 100 else (np.ones(n, bool), posterior)
    values = every[seen].astype(float)
    rest = np.zeros(values.shape)
    for y in (np.asarray(sure, float), 1 - np.asarray(sure, float)):
        mean = (values * y[:, None]).sum(0) / max(y.sum(), 1e-9)
        rest += (values - mean) * y[:, None]
    spread = np.sqrt((rest**2).mean(0)) + 1e-9
    correlation = np.abs(rest.T @ rest / len(rest) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    correlation[:, -1] = correlation[-1] = 0  # the given labels stand for themselves
    weight = 1 / (1 + np.where(correlation > 0.1, correlation, 0).sum(1))
    posterior = np.clip(0.5 + 0.45 * gold, 0.05, 0.95).astype(float) if known.any() else posterior
    chance = fit()
    return posterior, chance, weight


def inputs(counts: np.ndarray, n: int) -> np.ndarray:
    """The classifier's features: logarithms of the counts, and the patterns' measures on like scales."""
    held = np.log1p(counts[:, :n])
    distinct, dense, shout, address = counts[:, n : n + N_PATTERNS].T
    rest = [np.minimum(distinct, 5), np.minimum(20 * dense, 3), np.minimum(10 * shout, 1), np.minimum(address, 1)]
    return np.column_stack([held, *rest, np.ones(len(counts))])


def classifier(x: np.ndarray, target: np.ndarray, penalty: float = 0.5, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on posterior labels, by Newton steps; the bias, last, is free."""
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - target) + ridge * weights
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass(frozen=True)
class Model:
    lexicon: tuple[str, ...]
    weights: tuple[float, ...]


def labelled_sample(docs: DataFrame, labels: DataFrame, rule: Rule, doc_id: str, text: str) -> DataFrame:
    """(body, toxic) of the labelled documents to learn from: never held-out ones, at most ``rule.labelled``.

    The labels (a row of two numbers each, at most ``rule.labelled``) are broadcast, so
    the documents are filtered where they lie. Null labels, ids and texts are left out; of
    documents that share a labelled id, the one of least hash is taken, so the bound holds for them too.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(rule.labelled)
    body = docs.select(frames.col(doc_id).cast("bigint").alias("_id"), frames.col(text).alias("body"))
    met = body.where("body is not null").join(F.broadcast(known), "_id")
    one = met.groupBy("_id", "toxic").agg(F.min_by("body", F.struct(F.xxhash64("body"), "body")).alias("body"))
    return one.select("body", "toxic")


def mine(sample: DataFrame, rule: Rule) -> list[str]:
    """The lexicon: terms far more frequent in toxic documents, best first."""

    def start():
        def work(texts, toxic):
            yes, no = Counter(), Counter()
            for text, label in zip(texts, toxic):
                (yes if label else no).update(terms(text))
            for term in yes.keys() | no.keys():
                yield term, yes[term], no[term]

        return work

    totals = sample.agg(F.sum("toxic").alias("yes"), F.count("*").alias("n")).first()
    yes, no = totals.yes or 0, totals.n - (totals.yes or 0)
    found = frames.explode_rows(
        sample, [F.col("body"), F.col("toxic")], start, {"term": "string", "yes": "bigint", "no": "bigint"}
    )
    found = found.groupBy("term").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    often = (F.col("yes") + 0.5) / (yes + 1) / ((F.col("no") + 0.5) / (no + 1))
    best = found.where(F.col("yes") >= max(rule.least, rule.share * yes)).withColumn("often", often)
    best = best.where(F.col("often") >= rule.ratio).orderBy(
        (F.col("yes") * F.log("often")).desc(), "term"
    )
    return [row.term for row in best.limit(rule.voters).collect()]


def fit(docs: DataFrame, labels: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> Model:
    """The classifier, learned from at most ``rule.labelled`` labelled documents that are not held out.

    Without labelled documents, or without toxic ones, the lexicon is empty and every
    score is low. Repeated labels of a document count as toxic if one of them does.
    """
    sample = labelled_sample(docs, labels, rule, doc_id, text)
    lexicon = mine(sample, rule)
    n = len(lexicon)

    def start():
        reader = Reader(lexicon)

        def work(texts, toxic):
            for body, label in zip(texts, toxic):
                yield reader.read(body).tobytes(), label

        return work

    rows = frames.explode_rows(
        sample, [F.col("body"), F.col("toxic")], start, {"counts": "binary", "toxic": "int"}
    ).collect()  # at most rule.labelled rows of rule.voters numbers
    rows.sort(key=lambda r: (bytes(r.counts), r.toxic))  # sums in one order, whatever the partitions
    if not rows or not n:
        return Model((), (0.0,) * N_PATTERNS + (-4.0,))
    counts = np.stack([np.frombuffer(bytes(r.counts), np.float32) for r in rows])
    gold = np.array([1 if r.toxic else -1 for r in rows])
    posterior, _, _ = label_model(votes(counts, n), gold)
    return Model(tuple(lexicon), tuple(map(float, classifier(inputs(counts, n), posterior))))


def score(
    df: DataFrame, model: Model, text: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more).

    A null or empty text has no hits and gets the score of that. Texts are read whole,
    in their rows, without a shuffle. Columns of the new names are replaced, others
    kept but not looked at; repeated rows score alike; an empty table stays empty.
    """
    lexicon, weights = list(model.lexicon), np.array(model.weights)

    def start():
        reader = Reader(lexicon)

        def work(texts):
            counts = np.stack([reader.read(t or "") for t in texts])
            z = inputs(counts, len(lexicon)) @ weights
            for p in 1 / (1 + np.exp(-np.clip(z, -30, 30))):
                yield float(p), int(p >= 0.5)

        return work

    return frames.extend(df, [frames.col(text)], start, {score: "double", predicted: "int"})
