"""Substring dedup by sliding spans of sentences.

Every run of consecutive sentences that has enough words is hashed, and so is every run of parts of long
ones; a run found at several places stays at the first and is removed at the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import frames
from barloom.sources.scratch import materialize, new_path


@dataclass(frozen=True)
class Rule:
    """From each span on, the shortest run of spans with ``run_words`` words is hashed.

    Spans are sentences, which end at a line's end or after . ! ? (and closing quotes or brackets).
    Sentences of over ``whole`` words end besides after each word whose hash is the least of those up to
    ``reach`` words around it. Such ends depend on the words near them alone, so a passage has the same ones
    wherever it stands, but for its first and last few words. Runs of such parts count only
    if their first ``run_words`` words have ``distinct`` different ones; runs of whole sentences always do.
    """

    run_words: int = 20
    whole: int = 12
    reach: int = 3
    distinct: int = 8


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])
        return self.up[:n], self.down[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of 64-bit numbers made to hang on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _of_ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """A hash of each range of ``values``: polynomials from running sums, moved to the same power."""
    up, down = powers.to(len(values) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return _mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Layout:
    """A text's words (byte offsets), sentences and runs. A word ends at ASCII white space; A-Z counts as a-z."""

    size: int
    starts: np.ndarray
    sentence: np.ndarray  # of each word
    first: np.ndarray  # word a run begins with
    end: np.ndarray  # word after its last
    high: np.ndarray
    low: np.ndarray

    @property
    def n_sentences(self) -> int:
        return int(self.sentence[-1]) + 1 if len(self.sentence) else 0

    def offset(self, word: np.ndarray) -> np.ndarray:
        """Where a word begins; after the last one, the end of the text."""
        return np.concatenate([self.starts, [self.size]])[word]


class Reader:
    """Lays out texts, on whole arrays of their bytes and words."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.letters = _Powers(0x9E3779B97F4A7C15), _Powers(0xC2B2AE3D27D4EB4F)
        self.words = _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F)

    def read(self, text: str) -> Layout:
        data = np.frombuffer(text.encode(), np.uint8)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        n = len(starts)
        none = np.zeros(0, np.int64)
        if not n:
            return Layout(len(data), none, none, none, none, none, none)
        plain = (data + 32 * ((data >= 65) & (data <= 90))).astype(np.uint64) + np.uint64(1)
        codes = [_of_ranges(plain, starts, ends, powers) for powers in self.letters]

        closes = self._sentence_ends(data, starts, ends)
        begins = np.concatenate([[True], closes[:-1]])
        sentence = np.cumsum(begins) - 1
        long = np.bincount(sentence)[sentence] > self.rule.whole
        parts = begins | np.concatenate([[False], (long & self._least(codes[0]))[:-1]])

        need = self.rule.run_words
        runs = []
        for cut, always in ((np.flatnonzero(begins), True), (np.flatnonzero(parts), False)):
            until = np.searchsorted(cut, cut + need)
            enough = (until < len(cut)) | (cut + need <= n)
            first, end = cut[enough], np.append(cut, n)[until[enough]]
            if not always and len(first):
                varied = self._different(codes[0], first) >= self.rule.distinct
                first, end = first[varied], end[varied]
            runs.append(np.stack([first, end]))
        first, end = np.unique(np.concatenate(runs, axis=1), axis=1) if any(r.size for r in runs) else (none, none)
        high, low = (_of_ranges(code, first, end, powers).view(np.int64) for code, powers in zip(codes, self.words))
        return Layout(len(data), starts, sentence, first, end, high, low)

    @staticmethod
    def _sentence_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether a sentence ends with each word."""
        lines = np.cumsum(data == 10)
        after = np.append(starts[1:], len(data)) - 1
        newline = lines[after] > lines[ends - 1]
        last = ends - 1
        for _ in range(3):  # closing quotes and brackets
            closing = np.isin(data[last], np.frombuffer(b"\"')]", np.uint8)) & (last > starts)
            last = last - closing
        return newline | np.isin(data[last], np.frombuffer(b".!?", np.uint8))

    def _least(self, code: np.ndarray) -> np.ndarray:
        """Whether no word up to ``reach`` words before or after has a lesser hash."""
        least = np.ones(len(code), bool)
        for step in range(1, self.rule.reach + 1):
            least[step:] &= code[step:] <= code[:-step]
            least[:-step] &= code[:-step] <= code[step:]
        return least

    def _different(self, code: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many different words there are among the first ``run_words`` from each place."""
        order = np.argsort(code, kind="stable")
        same = code[order[1:]] == code[order[:-1]]
        before = np.full(len(code), -1)
        before[order[1:][same]] = order[:-1][same]
        places = first[:, None] + np.arange(self.rule.run_words)
        return (before[np.minimum(places, len(code) - 1)] < first[:, None]).sum(1)


_PLACES = {
    "high": pa.int64(), "low": pa.int32(), "id": pa.int64(), "version": pa.int64(),
    "start": pa.int32(), "size": pa.int32(), "sentence": pa.int32(), "more": pa.int32(),
}
_PLACES_DDL = "high bigint, low int, id bigint, version bigint, start int, size int, sentence int, more int"

#: Texts laid out before their places are handed on.
SLICE = 64


def _runs(one: int, version: int, found: Layout) -> list[np.ndarray]:
    """The columns of a text's places: hash, place, size in bytes, first sentence and how many more it reaches into."""
    n = len(found.first)
    start, sentence = found.offset(found.first), found.sentence[found.first]
    more = found.sentence[found.end - 1] - sentence
    return [found.high, found.low >> 32, np.full(n, one), np.full(n, version), start, found.offset(found.end) - start, sentence, more]


def _places(rule: Rule):
    """(id, version, text) batches to a row per run, and one per text, without a hash, with its sentences in ``more``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(rule)
        kinds = list(_PLACES.values())
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                ids, versions, texts = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                laid = [reader.read(text or "") for text in texts]
                runs = [_runs(one, version, found) for one, version, found in zip(ids, versions, laid) if one is not None]
                if runs:
                    columns = [np.concatenate(c) for c in zip(*runs)]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)).cast(k) for c, k in zip(columns, kinds)], names=list(_PLACES))
                own = [None, None, ids, versions, None, None, None, [found.n_sentences for found in laid]]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(ids), k) if c is None else pa.array(c, type=k) for c, k in zip(own, kinds)], names=list(_PLACES)
                )

    return work


_STREAMED_DDL = f"{_PLACES_DDL}, sure boolean"


def _stream():
    """Over places sorted by hash, id, version and start: those that are not the first of their hash (``sure``), and, not
    ``sure``, the first place here of the hash at either end of the partition, as others may lie before it. Holds a batch.
    """
    names = [*_PLACES, "sure"]

    def table(columns: list[np.ndarray], chosen: np.ndarray, sure: bool) -> pa.RecordBatch:
        picked = [pa.array(c[chosen]) for c in columns]
        if sure:  # the hash has done its work
            picked[:2] = [pa.nulls(len(picked[0]), kind) for kind in list(_PLACES.values())[:2]]
        return pa.RecordBatch.from_arrays([*picked, pa.array(np.full(len(picked[0]), sure))], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] | None = None  # the first place of the hash read last, one value a column
        runs = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[: len(_PLACES)]]
            high, low = columns[:2]
            new = np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
            goes_on = last is not None and high[0] == last[0][0] and low[0] == last[1][0]
            begins = np.flatnonzero(new)
            run = np.cumsum(new) - 1
            later = np.zeros(len(high), bool)
            for k in (2, 3, 4):
                first = columns[k][begins]
                if goes_on:
                    first[0] = last[k][0]
                later |= columns[k] != first[run]
            yield table(columns, later, True)
            if last is None:
                yield table(columns, np.array([0]), False)
            runs += len(begins) - goes_on
            if len(begins) > goes_on:
                last = [c[begins[-1:]] for c in columns]
        if runs > 1:
            yield table(last, np.array([0]), False)

    return work


def _later(runs: DataFrame) -> DataFrame:
    """Places of repeated runs but the first of each: smallest id, then version, then start.

    One range shuffle by hash, sorted by place within, so first occurrences come first in a stream and
    the passage of a third of all documents is spread over as many partitions: its places are part of the key,
    and so is the task that wrote them, as rows may repeat. What a partition cannot tell is whether the first places at
    its ends are the first of all; they are two rows a partition, and settled among themselves.
    """
    place = ["id", "version", "start"]
    order = ["high", "low", *place, F.spark_partition_id()]
    ordered = runs.repartitionByRange(*order).sortWithinPartitions("high", "low", *place)
    streamed = materialize(ordered.mapInArrow(_stream(), _STREAMED_DDL), "streamed")
    code = Window.partitionBy("high", "low")
    ends = streamed.where("not sure").withColumn("first", F.min(F.struct(*place)).over(code))
    columns = [*place, "size", "sentence", "more"]
    others = ends.where(F.struct(*place) > F.col("first"))
    return streamed.where("sure").select(columns).unionByName(others.select(columns)).distinct()


def _cuts(later: DataFrame) -> DataFrame:
    """(id, version, cuts, removed): stretches of bytes to cut, in order and apart, and how many sentences they touch."""
    later = later.select(
        "id", "version", "start", (F.col("start") + F.col("size")).alias("until"),
        F.col("sentence").alias("s0"), (F.col("sentence") + F.col("more")).alias("s1"),
    )
    own = Window.partitionBy("id", "version")
    along = own.orderBy("start", "until")
    reach = F.max("until").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))
    numbered = later.withColumn("opens", opens)
    numbered = numbered.withColumn("island", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("id", "version", "island").agg(
        F.min("start").alias("start"), F.max("until").alias("until"), F.min("s0").alias("s0"), F.max("s1").alias("s1")
    )
    shared = F.coalesce((F.lag("s1").over(own.orderBy("start")) == F.col("s0")).cast("int"), F.lit(0))
    counted = joined.withColumn("touched", F.col("s1") - F.col("s0") + 1 - shared)
    return counted.groupBy("id", "version").agg(
        F.sort_array(F.collect_list(F.struct("start", "until"))).alias("cuts"),
        F.sum("touched").cast("bigint").alias("removed"),
    )


def dedup(df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with repeated runs cut from the text, ``n_sentences``, and ``n_removed``, the sentences cut or cut into.

    A null text stays null, an empty one empty; both have no sentences. Rows with a null
    id are neither compared nor changed. Rows that repeat id and text hold the same
    places, so one does not make the other a repeat; rows that share an id with other
    texts are cut each by its own places, the first being that of the smallest hash of the text.
    Columns of the new names are replaced, others kept. An empty table stays empty.

    Texts are read by Python once, to write the places of their runs; the rest is one
    range shuffle of the runs' 96-bit hashes (a chance of 1 in 1,000 that any two of 10^13 meet), and one join of the texts with the bytes to cut, which
    sorts and merges at every size, as what it looks up grows with the documents.
    """
    others = [name for name in frames.without(df, ["n_sentences", "n_removed"]) if name.lower() != text.lower()]
    body = frames.col(text)
    rows = df.select(
        F.struct(*[frames.col(name) for name in others]).alias("row"),
        frames.col(doc_id).cast("bigint").alias("id"),
        F.xxhash64(body).alias("version"),
        body.alias("body"),
    )
    path = new_path(df.sparkSession, "places")
    found = rows.select("id", "version", "body").mapInArrow(_places(rule), _PLACES_DDL)
    found.write.option("compression", "zstd").parquet(path)  # the largest table by far, written and read once
    places = df.sparkSession.read.schema(found.schema).parquet(path)
    cuts = _cuts(_later(places.where("high is not null")))
    texts = places.where("high is null").groupBy("id", "version").agg(F.max("more").cast("bigint").alias("sentences"))
    told = materialize(texts.join(cuts, ["id", "version"], "left"), "cuts").hint("merge")

    same = F.col("r.id").eqNullSafe(F.col("t.id")) & (F.col("r.version") == F.col("t.version"))
    joined = rows.alias("r").join(told.alias("t"), same).select("row", "body", "sentences", "cuts", "removed")
    data = F.col("body").cast("binary")
    n = F.size("cuts")

    def piece(i):
        start = F.when(i == 0, 0).otherwise(F.get("cuts", i - 1)["until"])
        until = F.when(i == n, F.octet_length("body")).otherwise(F.get("cuts", i)["start"])
        return F.decode(F.substring(data, start + 1, until - start), "UTF-8")

    kept = F.array_join(F.transform(F.sequence(F.lit(0), n), piece), "")
    shown = F.when(F.col("cuts").isNull(), F.col("body")).otherwise(kept)
    return joined.select(
        "row.*", shown.alias(text), F.col("sentences").alias("n_sentences"), F.coalesce("removed", F.lit(0)).alias("n_removed")
    )
