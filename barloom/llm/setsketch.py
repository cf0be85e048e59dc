"""Near-duplicate documents by SetSketch registers.

A register is the exponentially spaced, truncated minimum of a hash over a
document's shingles: ``clip(floor(1 - log_b(h)), 0, q + 1)`` with ``h`` the least of
exponential values of rate ``a``. Registers of two sets merge by maximum, and agree
about as often as the sets' Jaccard similarity. Bands of registers propose pairs,
a likelihood over all registers estimates their similarity, and full sets decide.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import frames
from barloom.llm.components import connected
from barloom.sources.scratch import materialize

BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2

#: Documents compared with each other in one task, at most about twice as many.
BLOCK = 512
BLOCK_CHARS = 16_000_000


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingles(text: str | None, size: int) -> set[bytes]:
    """Distinct runs of ``size`` words; of fewer words, the whole; of none, nothing."""
    found = words(text)
    if len(found) <= size:
        return {b" ".join(found)} if found else set()
    return set(map(b" ".join, zip(*(found[i:] for i in range(size)))))


def coefficients(m: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    odd = random.integers(0, 2**31, m, dtype=np.uint64) * 2 + 1
    return odd.astype(np.uint32)[:, None], random.integers(0, 2**32, m, dtype=np.uint64).astype(np.uint32)[:, None]


def registers(hashes: np.ndarray, drawn: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The registers of a non-empty set of 64-bit hashes, one for each of the coefficients."""
    by, plus = drawn
    low = np.full(len(by), 2**32 - 1, np.uint32)
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), 1024):
        spread = by * values[at : at + 1024]
        spread += plus
        np.minimum(low, spread.min(axis=1), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(left, right)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs (rows) from registers and set sizes."""
    m = left.shape[1]
    more = (left > right).sum(axis=1).astype(float)
    less = (left < right).sum(axis=1).astype(float)
    same = m - more - less
    u = n_left / (n_left + n_right)
    v = 1 - u
    step = (BASE - 1) / BASE

    def p(x):
        return -np.log1p(-x * step) / math.log(BASE)

    def slope(x):
        return step / (math.log(BASE) * (1 - x * step))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):  # the derivative of the log likelihood falls in J
        j = (low + high) / 2
        a, b = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        rest = np.maximum(1 - p(a) - p(b), 1e-12)
        rising = (
            -more * v * slope(a) / p(a) - less * u * slope(b) / p(b)
            + same * (v * slope(a) + u * slope(b)) / rest
        ) > 0
        low, high = np.where(rising, j, low), np.where(rising, high, j)
    return (low + high) / 2


@dataclass(frozen=True)
class Near:
    """``size`` words a shingle; link where 100 * intersection >= ``percent`` * union.

    ``m`` registers; with ``per_band`` of them a band, the chance that a pair at the
    threshold shares no band is at most ``miss``. ``sigmas`` deviations below the
    threshold, an estimate rules a pair out.
    """

    size: int = 5
    percent: int = 80
    m: int = 160
    miss: float = 2e-5
    sigmas: float = 4.0

    @property
    def per_band(self) -> int:
        t = self.percent / 100
        return max([r for r in range(1, 17) if (1 - t**r) ** (self.m // r) <= self.miss], default=1)

    @property
    def least_estimate(self) -> float:
        t = self.percent / 100
        return t - self.sigmas * math.sqrt(t * (1 - t) / self.m)


def sketch(df: DataFrame, near: Near, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, digest of the set, registers, band values) of every row."""
    size, m, r = near.size, near.m, near.per_band

    def start():
        drawn = coefficients(m)

        def work(ids, texts):
            for one, text in zip(ids, texts):
                found = shingles(text, size)
                if not found:
                    yield one, 0, None, None, None
                    continue
                hashes = hashed(found)
                own = registers(hashes, drawn)
                bands = [
                    xxhash.xxh3_64_intdigest(own[i : i + r].tobytes(), seed=i) - 2**63
                    for i in range(0, m - r + 1, r)
                ]
                yield one, len(found), xxhash.xxh3_128_digest(hashes.tobytes()), own.tobytes(), bands

        return work

    fields = {"id": "bigint", "n_shingles": "bigint", "digest": "binary", "registers": "binary", "bands": "array<bigint>"}
    return frames.explode_rows(df, [frames.col(doc_id).cast("bigint"), frames.col(text)], start, fields)


def estimated(pairs: DataFrame, near: Near) -> DataFrame:
    """Pairs (u, v) whose registers do not rule them out; needs registers and sizes of both."""
    least = near.least_estimate

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.stack([np.frombuffer(x, np.uint16) for x in batch.column(k).to_pylist()]) for k in (2, 3))
            n = [batch.column(k).to_numpy().astype(float) for k in (4, 5)]
            keep = pa.array(estimate(a, b, *n) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["u", "v"])

    return pairs.select("u", "v", "ru", "rv", "nu", "nv").mapInArrow(run, "u bigint, v bigint")


def verified(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach the threshold; ``texts`` is (id, body)."""
    size, percent = near.size, near.percent

    def start():
        sets = functools.lru_cache(maxsize=256)(lambda text: shingles(text, size))

        def work(us, vs, left, right):
            for u, v, a, b in zip(us, vs, left, right):
                x, y = (sets(t) if len(t) < 50_000 else shingles(t, size) for t in (a, b))
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    yield u, v

        return work

    held = pairs.join(texts.select(F.col("id").alias("v"), F.col("body").alias("bv")), "v")
    held = held.join(texts.select(F.col("id").alias("u"), F.col("body").alias("bu")), "u")
    inputs = [F.col("u"), F.col("v"), F.col("bu"), F.col("bv")]
    return frames.explode_rows(held, inputs, start, {"u": "bigint", "v": "bigint"})


def hashed(found: set[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of a set of shingles."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    hashes.sort()
    return hashes


def _across(members: DataFrame, near: Near) -> DataFrame:
    """Links (u, v) that join different components of one group, by registers, then hashed sets.

    ``members``: (group, id, component, main, registers, n_shingles, body). Documents of
    the group's main component are compared with the others only, blocks with blocks; a
    block has about ``BLOCK`` documents or ``BLOCK_CHARS`` characters. Of the links between
    two blocks, those are returned that join what was not yet joined.
    """
    least, size, percent = near.least_estimate, near.size, near.percent
    members = members.withColumn("rest", F.col("component") != F.col("main"))

    def n_blocks(which: Column) -> Column:
        rows = F.sum(which.cast("long")) / BLOCK
        chars = F.sum(F.when(which, F.length("body")).otherwise(0)) / BLOCK_CHARS
        return F.ceil(F.greatest(rows, chars)).cast("long")

    counts = members.groupBy("group").agg(
        n_blocks(F.col("rest")).alias("n_rest"), n_blocks(~F.col("rest")).alias("n_main")
    )
    counts = materialize(counts.where("n_rest > 0"), "blocks")
    held = members.join(counts, "group").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.when(F.col("rest"), F.col("n_rest")).otherwise(F.col("n_main")))
    )
    none = F.array().cast("array<struct<kind:string,i:bigint,j:bigint>>")

    def cells(count: str, make):
        return F.when(
            F.col(count) > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col(count) - 1), make)
        ).otherwise(none)

    def cell(kind, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    block = F.col("block")
    held = held.withColumn(
        "cell",
        F.explode(
            F.when(
                F.col("rest"),
                F.concat(
                    cells("n_main", lambda k: cell("main", block, k)),
                    cells("n_rest", lambda k: cell("rest", F.least(block, k), F.greatest(block, k))),
                ),
            ).otherwise(cells("n_rest", lambda k: cell("main", k, block)))
        ),
    )

    def run(key, rows):
        ids, part = rows["id"].to_numpy(), rows["component"].to_pylist()
        sizes = rows["n_shingles"].to_numpy().astype(float)
        own = np.stack([np.frombuffer(x, np.uint16) for x in rows["registers"].to_pylist()])
        rest = rows["rest"].to_numpy(zero_copy_only=False)
        m = own.shape[1]
        left = np.flatnonzero(rest)
        right = np.flatnonzero(~rest) if key[1].as_py() == "main" else left
        above = {c: c for c in part}
        sets: dict[int, np.ndarray] = {}

        def root(c):
            while above[c] != c:
                above[c] = above[above[c]]
                c = above[c]
            return c

        def full(k):
            if k not in sets:
                sets[k] = hashed(shingles(rows["body"][int(k)].as_py(), size))
            return sets[k]

        us, vs = [], []
        for i in left:
            others = right[ids[right] > ids[i]] if right is left else right
            others = others[(own[others] == own[i]).sum(axis=1) >= (least - 0.05) * m]
            others = others[[root(part[k]) != root(part[i]) for k in others]] if len(others) else others
            if not len(others):
                continue
            likely = estimate(
                np.broadcast_to(own[i], (len(others), m)), own[others],
                np.full(len(others), sizes[i]), sizes[others],
            )
            for k in others[np.argsort(-likely, kind="stable")][: int((likely >= least).sum())]:
                a, b = root(part[i]), root(part[k])
                if a != b:
                    x, y = full(i), full(k)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        above[b] = a
                        us.append(ids[i])
                        vs.append(ids[k])
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    keys = ["group", "kind", "i", "j"]
    return (
        held.select("group", "cell.kind", "cell.i", "cell.j", "id", "component", "n_shingles", "registers", "rest", "body")
        .repartition(*keys)  # else all blocks of a group would stay in the task of the join
        .groupBy(*keys)
        .applyInArrow(run, "u bigint, v bigint")
    )


def near_duplicates(
    df: DataFrame, near: Near = Near(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``df``: (doc_id, n_shingles, component_id, kept).

    Links are transitive; ``component_id`` is the smallest id reachable and ``kept``
    marks the row that has it. Other columns are not looked at. Rows with a null id
    take no part: their component is null and they are kept. Texts that are null, empty
    or without words have no shingles and link with nothing. Rows that share an id
    are one document and are kept or dropped together. An empty table gives none.

    1. Rows with equal sets are one set, by a digest; its smallest id stands for it.
    2. In every bucket of a band, each set is paired with the smallest id (a star in
       place of all pairs). Registers, then full sets, confirm the pairs.
    3. Buckets that still hold several components: sets of different components are
       compared by registers, in blocks, and what is close is confirmed on full sets.
       Within two blocks, documents that are joined already are not compared again.

    So every pair that shares a band is either joined already or compared.
    """
    rows = materialize(sketch(df, near, doc_id, text), "sketches")
    linked = rows.where("id is not null and digest is not null")
    # Map-side minima, so that a set with very many copies sends a row per task.
    one = F.min(F.struct("id", "n_shingles", "registers", "bands")).alias("one")
    reps = materialize(linked.groupBy("digest").agg(one).select("digest", "one.*"), "reps")
    banded = reps.select("id", F.explode("bands").alias("band"))
    # What is aggregated is written before it is joined, so that joins can split large buckets.
    stars = banded.groupBy("band").agg(F.min("id").alias("center"), F.max("id").alias("last"))
    stars = materialize(stars.where("center < last"), "stars")
    buckets = materialize(banded.join(stars.select("band", "center"), "band"), "buckets")
    close = buckets.select("id").distinct()
    texts = materialize(
        df.select(frames.col(doc_id).cast("bigint").alias("id"), frames.col(text).alias("body"))
        .where("id is not null").join(close, "id").dropDuplicates(["id"]), "texts"
    )
    light = reps.select("id", "n_shingles", "registers")

    pairs = buckets.where("id <> center").select(F.col("center").alias("u"), F.col("id").alias("v")).distinct()
    pairs = pairs.join(light.select(F.col("id").alias("v"), F.col("registers").alias("rv"), F.col("n_shingles").alias("nv")), "v")
    pairs = pairs.join(light.select(F.col("id").alias("u"), F.col("registers").alias("ru"), F.col("n_shingles").alias("nu")), "u")
    first = connected(verified(estimated(pairs, near), texts, near))

    held = buckets.join(first.withColumnRenamed("node", "id"), "id", "left")
    held = held.withColumn("component", F.coalesce("component", "id"))
    mixed = held.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    mixed = materialize(mixed.where("a < b"), "mixed")
    main = first.select(F.col("node").alias("center"), F.col("component").alias("main"))
    members = (
        held.join(mixed.select("band"), "band").join(main, "center", "left")
        .withColumn("main", F.coalesce("main", "center"))
        .select(F.col("main").alias("group"), "main", "id", "component").distinct()
        .join(light, "id").join(texts, "id")
    )
    more = materialize(verified(_across(members, near).distinct(), texts, near), "links")
    part = first.select(F.col("node").alias("id"), "component")
    merged = (
        more.join(part.select(F.col("id").alias("u"), F.col("component").alias("cu")), "u", "left")
        .join(part.select(F.col("id").alias("v"), F.col("component").alias("cv")), "v", "left")
        .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    )
    second = connected(merged).select(F.col("node").alias("component"), F.col("component").alias("final"))
    part = part.join(second, "component", "left").select("id", F.coalesce("final", "component").alias("component"))
    part = part.unionByName(
        second.select(F.col("component").alias("id"), F.col("final").alias("component"))
    ).distinct()
    final = materialize(
        reps.select("digest", "id").join(part, "id", "left")
        .select("digest", F.coalesce("component", "id").alias("component")), "final"
    )
    lone = rows.where("id is null or digest is null").withColumn("component", F.col("id"))
    done = linked.join(final, "digest").unionByName(lone.select("digest", *[c for c in linked.columns if c != "digest"], "component"))
    return done.select(
        F.col("id").alias(doc_id),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"),
    )
