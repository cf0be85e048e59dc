"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the benchmark items. Reading a document's
words, it knows at each word the longest run ending there that some item has, so
windows of any length are found in one pass over the document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import frames

#: Words of ASCII letters and digits and of all other characters, after lower-casing A-Z.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Benchmark bytes in one automaton. It is sent to every task (some 100 bytes for
#: each of at most two states a word); a larger benchmark is read in several blocks.
BLOCK_BYTES = 8_000_000


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class Automaton:
    """Generalised suffix automaton over items; finds the items' windows in a document."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.moves: list[dict[bytes, int]] = [{}]
        self.links, self.lengths = [-1], [0]
        self.window = window
        for _, item in items:
            last = 0
            for word in item:
                last = self._add(last, word)
        at: list[dict[int, list[int]]] = [{} for _ in self.moves]
        for item_id, item in items:
            for end in self._ends(item, window):
                at[end[0]].setdefault(end[1], []).append(item_id)
        order = sorted(range(len(self.moves)), key=self.lengths.__getitem__)
        #: by state: (length, items) of the windows that end wherever it does, shortest first
        self.ending: list[tuple] = [()] * len(self.moves)
        for state in order[1:]:
            own = tuple((length, tuple(dict.fromkeys(ids))) for length, ids in sorted(at[state].items()))
            self.ending[state] = self.ending[self.links[state]] + own

    def _new(self, length: int, moves: dict, link: int) -> int:
        self.moves.append(moves)
        self.links.append(link)
        self.lengths.append(length)
        return len(self.moves) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for the shorter runs that also end at ``state`` + word."""
        copy = self._new(self.lengths[state] + 1, dict(self.moves[target]), self.links[target])
        self.links[target] = copy
        while state >= 0 and self.moves[state].get(word) == target:
            self.moves[state][word] = copy
            state = self.links[state]
        return copy

    def _add(self, last: int, word: bytes) -> int:
        there = self.moves[last].get(word)
        if there is not None:
            return there if self.lengths[there] == self.lengths[last] + 1 else self._split(last, word, there)
        new = self._new(self.lengths[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.moves[state]:
            self.moves[state][word] = new
            state = self.links[state]
        if state >= 0:
            target = self.moves[state][word]
            exact = self.lengths[target] == self.lengths[state] + 1
            self.links[new] = target if exact else self._split(state, word, target)
        return new

    def _ends(self, item: list[bytes], window: int):
        """(state, length) of every window of an item; a shorter item is one window."""
        length = min(window, len(item))
        state = 0
        for i, word in enumerate(item):
            state = self.moves[state][word]
            if i + 1 >= length > 0:
                while self.lengths[self.links[state]] >= length:
                    state = self.links[state]
                yield state, length

    def read(self, document: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Hit runs (start, end) of words in order, merged; items found; longest matching run."""
        moves, links, lengths, ending = self.moves, self.links, self.lengths, self.ending
        root = moves[0]
        state = length = longest = 0
        runs: list[tuple[int, int]] = []
        found: set[int] = set()
        for i, word in enumerate(document):
            if state:
                there = moves[state].get(word)
                while there is None and state:
                    state = links[state]
                    length = lengths[state]
                    there = moves[state].get(word)
            else:
                there = root.get(word)
            if there is None:
                continue
            state = there
            length += 1
            if length > longest:
                longest = length
            if ending[state]:
                reach = 0
                for size, ids in ending[state]:
                    if size <= length:
                        reach = size
                        found.update(ids)
                if reach:
                    begin = i + 1 - reach
                    while runs and runs[-1][1] >= begin:
                        begin = min(begin, runs.pop()[0])
                    runs.append((begin, i + 1))
        return runs, found, longest


def without_runs(text: str | None, flat: list[int] | None) -> str | None:
    """The text without the runs of words (start, end, start, ...), and without what lies between their words."""
    if not flat or text is None:
        return text
    data = text.encode()
    at = [(m.start(), m.end()) for m in WORD.finditer(data.lower())]
    parts, done = [], 0
    for a, b in zip(flat[::2], flat[1::2]):
        parts.append(data[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*parts, data[done:]]).decode()


@dataclass(frozen=True)
class Rule:
    """Windows of ``window`` words; contaminated where ``share`` * hit words >= all words."""

    window: int = 13
    share: int = 20


def blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> list[list[tuple[int, str]]]:
    """Items in blocks of at most about ``size`` bytes, fetched block by block."""
    items = benchmark.select(frames.col(item_id).alias("id"), frames.col(text).alias("body"))
    items = items.where("body is not null")
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = -(-total // size) if total else 0
    if n <= 1:
        return [[tuple(row) for row in items.collect()]] if n else []
    part = F.pmod(F.xxhash64("id", "body"), F.lit(n))
    return [[tuple(row) for row in items.where(part == i).collect()] for i in range(n)]


def scan(
    df: DataFrame,
    benchmark: DataFrame,
    rule: Rule = Rule(),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
    cut: bool = False,
) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit``, ``items`` (found, as strings in order), ``longest``, ``spans``, ``contaminated``.

    ``spans`` are the hit runs of words, flat: start, end (exclusive), start, ... A word
    inside any occurrence of a window is hit. A null or empty text has no words and is
    clean; null items, and items without words, have no window; the windows of an item without
    an id count as hit, but it is not among ``items``. Columns of the new names
    are replaced, others kept; repeated rows are judged alike; an empty benchmark finds
    nothing. Documents are read in place, without a shuffle. A benchmark over
    ``block_bytes`` is held block by block: all documents are read against each block in
    turn in the same task, and hits of all blocks are united. ``prefix`` goes before
    the new columns' names. With ``cut``, the text loses its hit runs in the same pass.
    """
    sc = df.sparkSession.sparkContext
    # Tasks build the automaton from the items: they are far smaller than it is.
    held = [sc.broadcast(block) for block in blocks(benchmark, item_id, item_text, block_bytes)]
    window, share = rule.window, rule.share

    def start():
        single = [Automaton([(i, words(t)) for i, t in held[0].value], window)] if len(held) == 1 else None

        def work(texts):
            documents = [words(t) for t in texts]
            found = [([], set(), 0) for _ in documents]
            for block in single or held:
                machine = block if single else Automaton([(i, words(t)) for i, t in block.value], window)
                for k, document in enumerate(documents):
                    runs, ids, longest = machine.read(document)
                    found[k] = (found[k][0] + runs, found[k][1] | ids, max(found[k][2], longest))
            for body, document, (runs, ids, longest) in zip(texts, documents, found):
                spans: list[list[int]] = []
                for a, b in sorted(runs):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                n, hit = len(document), sum(b - a for a, b in spans)
                flat = [x for span in spans for x in span]
                row = n, hit, sorted(str(i) for i in ids if i is not None), longest, flat, hit > 0 and share * hit >= n
                yield (*row, without_runs(body, flat)) if cut else row

        return work

    fields = {
        "n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "longest": "bigint",
        "spans": "array<bigint>", "contaminated": "boolean",
    }
    fields = {prefix + name: kind for name, kind in fields.items()} | ({text: "string"} if cut else {})
    return frames.extend(df, [frames.col(text)], start, fields)


def remove_spans(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with the hit runs of words cut out of the text; null or no spans leave it as it is."""

    def start():
        return lambda texts, all_spans: [(without_runs(body, flat),) for body, flat in zip(texts, all_spans)]

    return frames.extend(df, [frames.col(text), frames.col(spans)], start, {text: "string"})
