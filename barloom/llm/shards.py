"""Sharding by sampled splitters: ranges of a key, near equal in bytes.

Keys are the hash of the text, then the document's id, then the row's number, so equal texts are
neighbours, and a group of copies of any size, or of equal rows, can still be divided.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import frames
from barloom.sources.scratch import materialize

#: Splitters are chosen from about this many sampled keys; the sample is the only thing sent to the driver.
SAMPLE = 20_000

#: Ranges at least, and at most; between, one for so many rows. A range of more than twice its share is split again.
RANGES, MOST_RANGES, RANGE_ROWS = 256, 4096, 1_000_000

Key = tuple[int, int, int]


def _search(bounds: list[Key]) -> Column:
    """Number of bounds at or before the key (a, b, c): whole groups of bounds first, then one group."""
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def literal(keys):
        return "array(" + ", ".join(f"struct({a}L as a, {b}L as b, {c}L as c)" for a, b, c in keys) + ")"

    if not groups:
        return F.lit(0)
    key = F.struct("a", "b", "c")
    tops = F.expr(literal([group[-1] for group in groups]))
    full = F.size(F.filter(tops, lambda bound: bound <= key))
    each = F.expr("array(" + ", ".join(map(literal, groups)) + ")")
    rest = F.size(F.filter(F.coalesce(F.get(each, full), F.expr("array()")), lambda bound: bound <= key))
    return full * F.lit(step) + F.when(full < len(groups), rest).otherwise(0) - F.when(
        full == len(groups), F.lit(len(groups) * step - len(bounds))
    ).otherwise(0)


def splitters(keys: DataFrame, n: int, total: int, sample: int = SAMPLE) -> list[Key]:
    """At most ``n - 1`` keys that part ``keys`` (a, b, c, size) into ranges of about equal size.

    A key is drawn with a chance in proportion to its size (always, if it alone is a
    sample's share), by a hash, so that a repeated task draws the same. A drawn key
    stands for its size over its chance. At most about twice ``sample`` keys come to
    the driver, however many there are.
    """
    share = max(1.0, total / sample)
    chance = F.least(F.lit(1.0), F.col("size") / F.lit(share))
    drawn = keys.where(F.pmod(F.xxhash64("a", "b", "c", F.lit(11)), F.lit(1 << 30)) < chance * (1 << 30))
    rows = sorted((r.a, r.b, r.c, max(float(r.size), share)) for r in drawn.select("a", "b", "c", "size").collect())
    whole, seen, found = sum(r[-1] for r in rows), 0.0, []
    for *key, weight in rows:
        if seen >= whole * (len(found) + 1) / n and len(found) < n - 1:
            found.append(tuple(key))
        seen += weight
    return found


def assign(
    df: DataFrame, size: Column, shards: int = 8, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``df``: near equal bytes a shard.

    Only keys, sizes and checksums are moved, never texts. Keys are parted into
    ``ranges`` by sampled splitters (by the number of rows, unless given); ranges found to hold over twice their share are
    parted again by splitters of their own, until none does. Exact sums of the ranges then give each
    record its place in the order of all bytes, and the place gives the shard: sizes of
    shards differ by less than the largest records at their edges. ``slot`` counts
    from 0 in each shard without gaps, in key order.

    Equal texts are neighbours, so a group of them lies in one shard, or in shards that follow
    each other where an edge falls within it: near equal sizes come first, as a group may be larger than a shard.

    A null text has no bytes and checksum 0; a null id sorts first; rows that repeat
    id and text are told apart by their place in the table of keys, so any number of them is spread over as many
    ranges as others of their size. Other columns are not looked at. An empty table gives no rows.
    """
    body = F.coalesce(frames.col(text), F.lit(""))
    keys = df.select(
        frames.col(doc_id).alias("id"),
        F.xxhash64(body).alias("a"),
        F.coalesce(frames.col(doc_id).cast("bigint"), F.lit(-(2**63) + 1)).alias("b"),
        F.monotonically_increasing_id().alias("c"),  # as written, so the same for all who read it
        size.cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    keys = materialize(keys, "keys")
    whole = keys.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    total = whole["size"] or 0
    if ranges is None:
        ranges = min(MOST_RANGES, max(RANGES, whole["n"] // RANGE_ROWS))
    bounds = splitters(keys, ranges, total, max(SAMPLE, 40 * ranges))

    def ranged(bounds):
        return keys.withColumn("range", _search(bounds))

    def sums(bounds):
        found = ranged(bounds).groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        return {r.range: (r.size, r.n) for r in found.collect()}

    held = sums(bounds)
    # Subdivide all overfull ranges in one pass, each with splitters in proportion to its excess; a single record can't be.
    while full := {k: size for k, (size, n) in held.items() if size > 2 * total / ranges and n > 1}:
        picked = ranged(bounds).where(F.col("range").isin(list(full)))
        extra = splitters(picked, 1 + sum(-(-size * ranges // total) for size in full.values()), sum(full.values()))
        finer = sorted({*bounds, *extra})
        if len(finer) == len(bounds):
            break
        bounds = finer
        held = sums(bounds)

    # Bytes and rows before each range; the shard of a record is that of its middle byte.
    bytes_before, rows_before, so_far, rows = {}, {}, 0, 0
    for one in range(len(bounds) + 1):
        bytes_before[one], rows_before[one] = so_far, rows
        so_far, rows = so_far + held.get(one, (0, 0))[0], rows + held.get(one, (0, 0))[1]
    order = Window.partitionBy("range").orderBy("a", "b", "c")
    step = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def looked_up(values):
        return F.get(F.expr("array(" + ", ".join(f"{values[k]}L" for k in sorted(values)) + ")"), F.col("range"))

    placed = (
        ranged(bounds)
        .withColumn("end", looked_up(bytes_before) + F.sum("size").over(step))
        .withColumn("row", looked_up(rows_before) + F.row_number().over(order) - 1)
        .withColumn(
            "shard",
            F.least(
                F.floor((F.col("end") * 2 - F.col("size")) * F.lit(shards) / F.lit(max(1, 2 * total))).cast("int"),
                F.lit(shards - 1),
            ),
        )
    )
    placed = materialize(placed.select("id", "size", "text_crc32", "shard", "row"), "placed")
    first = {r.shard: r.row for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}
    slot = F.col("row") - F.create_map(*[F.lit(x) for k, v in (first or {0: 0}).items() for x in (k, v)])[F.col("shard")]
    return placed.select(
        F.col("id").alias(doc_id), "size", "text_crc32", "shard", slot.cast("bigint").alias("slot")
    )
