"""Line dedup: a long line that many documents share stays in the last of them only.

Hashes of lines are range-partitioned and sorted by hash, document (last first) and
position, so that each line's first occurrence comes first in a stream. What comes
back is a bitmap of lines to keep per document, not text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import frames
from barloom.sources.scratch import materialize

SPACE = b" \t\n\x0b\x0c\r"
_WORD = 2**64 - 1


@dataclass(frozen=True)
class Rule:
    """Lines of ``least_chars`` code points (ends stripped, A-Z as a-z) in ``least_documents`` documents."""

    least_chars: int = 40
    least_documents: int = 5


def keys(text: str, rule: Rule) -> Iterator[tuple[int, int, int]]:
    """(line number, two halves of the key's 128-bit hash) of each line that counts."""
    for number, line in enumerate(text.encode().split(b"\n")):
        key = line.strip(SPACE).lower()
        if len(key) >= rule.least_chars and (key.isascii() or len(key.decode()) >= rule.least_chars):
            code = xxhash.xxh3_128_intdigest(key)
            yield number, (code >> 64) - 2**63, (code & _WORD) - 2**63


def pack(n_lines: int, dropped: list[int]) -> bytes:
    """A keep bitmap as run lengths: lines kept, lines dropped, and so on, as base-128 numbers."""
    runs, at = [], 0
    i = 0
    while i < len(dropped):
        end = i
        while end + 1 < len(dropped) and dropped[end + 1] == dropped[end] + 1:
            end += 1
        runs += [dropped[i] - at, end + 1 - i]
        at, i = dropped[end] + 1, end + 1
    out = bytearray()
    for run in [*runs, n_lines - at]:
        while run > 127:
            out.append(run & 127 | 128)
            run >>= 7
        out.append(run)
    return bytes(out)


def unpack(bitmap: bytes) -> list[bool]:
    """Whether each line is kept."""
    found: list[bool] = []
    run = shift = 0
    keep = True
    for byte in bitmap:
        run |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            found += [keep] * run
            run = shift = 0
            keep = not keep
    return found


def kept_text(text: str, bitmap: bytes) -> str:
    return "\n".join(line for line, keep in zip(text.split("\n"), unpack(bitmap)) if keep)


class _Run:
    """One hash's rows as they stream by, last document first."""

    def __init__(self, code: tuple[int, int], opens: bool):
        self.code, self.opens = code, opens  # opens: may have begun in the partition before
        self.top = self.last = None
        self.documents = 0
        self.held: list[tuple] = []


_STREAMED = {
    "high": pa.int64(), "low": pa.int64(), "doc": pa.int64(), "version": pa.binary(), "line": pa.int32(),
    "documents": pa.int64(), "top": pa.int64(), "sure": pa.bool_(),
}
_STREAMED_DDL = "high bigint, low bigint, doc bigint, version binary, line int, documents bigint, top bigint, sure boolean"


def _stream(least: int):
    """Over sorted rows: those to drop (``sure``), those that hang on what other partitions hold of
    their hash, and for the hash at either end of a partition a row of its number of ``documents``.

    Memory: a batch, and the lines of the first ``least`` - 1 documents of one hash.
    """

    def table(code, doc, version, line, sure) -> pa.RecordBatch:
        n = len(doc)
        columns = [
            pa.array(np.full(n, code[0])), pa.array(np.full(n, code[1])), pa.array(doc), version, pa.array(line),
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, sure)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=list(_STREAMED))

    def summary(run: _Run) -> pa.RecordBatch:
        row = [run.code[0], run.code[1], run.last, None, None, run.documents, run.top, None]
        return pa.RecordBatch.from_arrays(
            [pa.array([value], type=kind) for value, kind in zip(row, _STREAMED.values())], names=list(_STREAMED)
        )

    def feed(run: _Run, doc, version, line) -> Iterator[pa.RecordBatch]:
        run.documents += 1 + int((doc[1:] != doc[:-1]).sum()) - (run.last == doc[0])
        run.last = int(doc[-1])
        if run.top is None:
            run.top = int(doc[0])
        if run.opens:
            yield table(run.code, doc, version, line, False)
            return
        later = np.flatnonzero(doc != run.top)
        if len(later):
            run.held.append((doc[later], version.take(pa.array(later)), line[later]))
        if run.documents >= least:
            for part in run.held:
                yield table(run.code, *part, True)
            run.held = []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            high, low, doc, line = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
            version = batch.column(3)
            starts = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
            ends = np.r_[starts[1:], n]
            # A hash with fewer rows than documents needed matters only at the ends of the batch.
            wanted = ends - starts >= least
            wanted[0] = wanted[-1] = True
            for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist()):
                code = (int(high[a]), int(low[a]))
                if run is None or run.code != code:
                    if run is not None and run.opens:
                        yield summary(run)
                    run = _Run(code, opens=run is None)
                yield from feed(run, doc[a:b], version.slice(a, b - a), line[a:b])
        if run is not None:
            for part in run.held:
                yield table(run.code, *part, False)
            yield summary(run)

    return work


def repeated(df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, line): the lines to drop; ``version`` is the text's MD5, as ids may repeat.

    One range shuffle of the hashes of long lines, 48 bytes each. A line that a third of
    all documents share is spread over as many partitions, as document and position
    are part of the sort key; rows that repeat id and text are made one on the map side.
    The ends of partitions, two rows each, are settled afterwards.
    """
    source = df.select(frames.col(doc_id).cast("bigint").alias("doc"), frames.col(text).alias("body"))
    source = source.where("doc is not null and body is not null")

    def start():
        def work(docs, versions, bodies):
            for doc, version, body in zip(docs, versions, bodies):
                for number, high, low in keys(body, rule):
                    yield high, low, doc, version, number

        return work

    fields = {"high": "bigint", "low": "bigint", "doc": "bigint", "version": "binary", "line": "int"}
    inputs = [F.col("doc"), F.unhex(F.md5("body")), F.col("body")]
    places = materialize(frames.explode_rows(source, inputs, start, fields).distinct(), "lines")
    order = [F.col("high"), F.col("low"), F.col("doc").desc(), F.col("version"), F.col("line")]
    ordered = places.repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = materialize(ordered.mapInArrow(_stream(rule.least_documents), _STREAMED_DDL), "streamed")

    # A document cut by the end of a partition counts in both parts; the rows of a hash here are one per partition.
    along = Window.partitionBy("high", "low").orderBy(F.desc("top"), F.desc("doc"))
    again = F.coalesce((F.lag("doc").over(along) == F.col("top")).cast("int"), F.lit(0))
    ends = streamed.where("documents is not null").withColumn("documents", F.col("documents") - again)
    met = ends.groupBy("high", "low").agg(F.sum("documents").alias("documents"), F.max("top").alias("top"))
    met = met.where(F.col("documents") >= rule.least_documents).select("high", "low", F.col("top").alias("stays"))
    # Two rows a partition at most, of 24 bytes, so fit to broadcast whatever the input; a hot hash stays spread.
    unsure = streamed.where("not sure").join(F.broadcast(met), ["high", "low"]).where("doc <> stays")
    columns = ["doc", "version", "line"]
    return streamed.where("sure").select(columns).unionByName(unsure.select(columns))


def keep_bitmaps(
    df: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text", kept_sha256: str | None = None
) -> DataFrame:
    """``df`` without its text, with ``n_lines``, ``n_dropped`` and ``keep``, the bitmap of lines that stay.

    A line's key is the line stripped of ASCII white space at both ends, A-Z as a-z. Keys
    long enough and in enough documents lose all their lines but those of the largest
    id that holds them (all of these, if it repeats the line). ``kept_sha256`` names a further column with the
    lowercase SHA-256 of the kept lines, joined by a line feed.

    A null or empty text has one line, empty, which stays. Documents are told apart by id:
    rows that share one count once and stay or go together, each by its own lines; rows
    without an id are not counted and lose nothing. Columns of the new names are
    replaced, others but the text kept. An empty table stays empty.
    """
    dropped = repeated(df, rule, doc_id, text).groupBy("doc", "version")
    dropped = materialize(dropped.agg(F.sort_array(F.collect_set("line")).alias("dropped")), "dropped")
    new = ["n_lines", "n_dropped", "keep"] + [kept_sha256] * (kept_sha256 is not None)
    others = [name for name in frames.without(df, new) if name.lower() != text.lower()]
    body = frames.col(text)
    rows = df.select(
        F.struct(*[frames.col(name) for name in others]).alias("row"),
        frames.col(doc_id).cast("bigint").alias("doc"),
        F.unhex(F.md5(body)).alias("version"),
        body.alias("body"),
    )
    joined = rows.join(dropped, ["doc", "version"], "left").select("row", "body", "dropped")

    def start():
        def work(bodies, all_dropped):
            for body, dropped in zip(bodies, all_dropped):
                body, dropped = body or "", dropped or []
                n = body.count("\n") + 1
                row = (n, len(dropped), pack(n, dropped))
                if kept_sha256 is not None:
                    kept = kept_text(body, row[2]) if dropped else body
                    row += (hashlib.sha256(kept.encode()).hexdigest(),)
                yield row

        return work

    fields = {"n_lines": "bigint", "n_dropped": "bigint", "keep": "binary"}
    fields |= {kept_sha256: "string"} if kept_sha256 is not None else {}
    marked = frames.extend(joined, [F.col("body"), F.col("dropped")], start, fields, drop=("body", "dropped"))
    return marked.select("row.*", *[frames.col(name) for name in fields])


def apply(marked: DataFrame, text: str = "text", keep: str = "keep") -> DataFrame:
    """``marked`` (a text and its bitmap) with the kept lines as text; a null text stays null."""

    def start():
        def work(bodies, bitmaps):
            for body, bitmap in zip(bodies, bitmaps):
                yield (None if body is None else kept_text(body, bitmap),)

        return work

    return frames.extend(marked, [frames.col(text), frames.col(keep)], start, {text: "string"})
