"""Joins by time: the latest row before each row, and the intervals around it."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.columns import utc_instant


def _name(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _row(df: DataFrame, columns: list[str]) -> Column:
    return F.struct(*[_name(name) for name in columns])


def _refuse_clashes(left: list[str], right: list[str]) -> None:
    taken = {name.lower() for name in left}
    clashing = [name for name in right if name.lower() in taken]
    if clashing:
        raise ValueError(f"both sides have {', '.join(clashing)}; rename one")


def _none_null(names: list[str]) -> Column:
    there = F.lit(True)
    for name in names:
        there = there & _name(name).isNotNull()
    return there


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_at: str,
    right_at: str,
    values: list[str],
    slice_of: Callable[[Column], Column] = F.to_date,
    strict: bool = False,
) -> DataFrame:
    """Each row of ``left`` with ``values`` of the latest row of ``right`` that has the same ``by``.

    Latest is the greatest ``right_at`` up to ``left_at``, or before it if ``strict``; of rows of one
    time, the one whose values come last. Every left row stays, with null
    values where there is none, or where its own key or time is null; right rows without them match nothing.

    No row is compared with the rows of the other side. Both are laid together and
    sorted, and what was seen last is carried forward. That happens in slices of one key, by
    ``slice_of`` the time (a function that never decreases: days unless given), so a key with a
    third of all rows is sorted by as many tasks as it has slices. What a slice
    begins with, one row each, is carried over from the last slice before that has a right row:
    an aggregate that combines on the map side, and a window over a key's slices. Both sides are read
    for that and again for the join, so pass written tables where they are dear.
    """
    _refuse_clashes(left.columns, values)
    keys = [f"k{i}" for i in range(len(by))]
    named = [_name(name).alias(key) for name, key in zip(by, keys)]
    kind = T.StructType([right.schema[name] for name in values])

    def laid(df: DataFrame, at: str, side: int, row: Column, found: Column) -> DataFrame:
        time = _name(at)
        return df.where(_none_null([*by, at])).select(
            *named, slice_of(time).alias("slice"), time.alias("at"), F.lit(side).alias("side"),
            row.alias("row"), found.alias("found"),
        )

    row_kind = T.StructType(left.schema.fields)
    rows = laid(left, left_at, 1, _row(left, left.columns), F.lit(None).cast(kind))
    known = laid(right, right_at, 2 if strict else 0, F.lit(None).cast(row_kind), _row(right, values))

    newest = known.groupBy(*keys, "slice").agg(F.max(F.struct("at", "found")).alias("newest"))
    asked = rows.select(*keys, "slice").distinct().withColumn("newest", F.lit(None).cast(newest.schema["newest"].dataType))
    slices = newest.unionByName(asked).groupBy(*keys, "slice").agg(F.max("newest").alias("newest"))
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(
        *keys, "slice", F.last("newest", ignorenulls=True).over(earlier).alias("before")
    ).where("before is not null")
    carried = carried.select(
        *keys, "slice", F.lit(None).cast(rows.schema["at"].dataType).alias("at"), F.lit(-1).alias("side"),
        F.lit(None).cast(row_kind).alias("row"), F.col("before.found").alias("found"),
    )

    so_far = (
        Window.partitionBy(*keys, "slice")
        .orderBy(F.asc_nulls_first("at"), "side", "found")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        rows.unionByName(known)
        .unionByName(carried)
        .withColumn("last", F.last("found", ignorenulls=True).over(so_far))
        .where("row is not null")
        .select("row.*", *[F.col("last").getField(name).alias(name) for name in values])
    )
    lost = left.where(~_none_null([*by, left_at])).select(
        *[_name(name) for name in left.columns], *[F.lit(None).cast(right.schema[name].dataType).alias(name) for name in values]
    )
    return matched.unionByName(lost)


#: How many bins an interval may lie in, for the sake of fewer classes.
BINS_PER_INTERVAL = 1024


def _whole(df: DataFrame, name: str, inside: str | None = None) -> Column:
    """A day, instant or whole number as a number; ``inside`` names the struct it has been put in."""
    kind = df.schema[name].dataType
    value = F.col(inside).getField(name) if inside else _name(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(utc_instant(value))
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    raise ValueError(f"{name} is neither a day, an instant nor a whole number")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    by: list[str],
    at: str,
    start: str,
    end: str,
    split: int = 3,
) -> DataFrame:
    """Every pair of a point and an interval of the same ``by`` with ``start`` <= ``at`` <= ``end``.

    Columns of both, ``by`` once. Intervals may overlap and repeat; those without a key, start or
    end, or that end before they start, hold no point, and points without a key or time lie in none.

    Time is cut into bins per class of length: an interval under 2^c long, c a multiple of ``split``, lies in bins of
    2^(c - ``split``), 2^``split`` + 1 of them at most, and a point in one bin per class. So both meet by
    equality, with no loop over all pairs: an interval over the whole history costs as few rows as a
    short one, and a bin that holds a pair's interval is no longer than
    it. The points of a key that holds a third of them are spread over its bins. Classes are
    64 over ``split`` at most; those that occur come to the driver, with their numbers of intervals.

    A point is copied once per class, so where long intervals are few beside the others, they take the bins of a lower class:
    the lowest that at most doubles the bins all intervals may lie in, with ``BINS_PER_INTERVAL`` for any.
    """
    others = [name for name in intervals.columns if name.lower() not in {b.lower() for b in by}]
    _refuse_clashes(points.columns, others)
    keys = [f"k{i}" for i in range(len(by))]
    named = [_name(name).alias(key) for name, key in zip(by, keys)]
    first, last = _whole(intervals, start, "interval"), _whole(intervals, end, "interval")
    now = _whole(points, at, "point")
    bounds = [name for name in (start, end) if name.lower() not in {other.lower() for other in others}]
    own = [name for name in points.columns if name not in by or name.lower() == at.lower()]

    step = max(split, 1)
    bits = F.ceil(F.when(last == first, 0).otherwise(F.length(F.bin(last - first))) / step).cast("int") * step
    sound = intervals.where(_none_null([*by, start, end])).select(*named, _row(intervals, [*others, *bounds]).alias("interval"))
    sound = sound.where(first <= last).withColumn("class", F.greatest(bits - split, F.lit(0)))
    held = {row["class"]: row["count"] for row in sound.groupBy("class").count().collect()}
    highest = _highest_class(held, split, step)
    classes = sorted({min(c, highest) for c in held})

    def bin_of(value: Column) -> Column:
        return F.call_function("shiftright", value, F.col("class"))

    # No row has a number beside the value that it is made from: every byte here is shuffled, once per class or bin.
    binned = sound.withColumn("class", F.least("class", F.lit(highest))).withColumn(
        "bin", F.explode(F.sequence(bin_of(first), bin_of(last)))
    )
    placed = points.where(_none_null([*by, at])).select(
        *named, _row(points, own).alias("point"),
        F.explode(F.array(*[F.lit(c) for c in classes]).cast("array<int>")).alias("class"),
    )
    p, i = placed.alias("p"), binned.alias("i")
    same = F.lit(True)
    for key in [*keys, "class"]:
        same &= F.col(f"p.{key}") == F.col(f"i.{key}")
    same &= F.call_function("shiftright", now, F.col("p.class")) == F.col("i.bin")
    # Intervals are many times what they were once laid in bins, so their size as stored must not have them broadcast.
    met = p.join(i.hint("merge"), same & now.between(first, last))
    key_of = {name: F.col(f"p.{key}") for name, key in zip(by, keys)}
    columns = [key_of.get(name, F.col("point").getField(name)).alias(name) for name in points.columns]
    return met.select(*columns, *[F.col("interval").getField(name).alias(name) for name in others])


def _highest_class(held: dict[int, int], split: int, step: int) -> int:
    """The class that higher ones are put in, for intervals of so many per class: see ``interval_join``."""
    top = max(held, default=0)
    for c in range(0, top, step):
        if 2 ** (top + split - c) > BINS_PER_INTERVAL:
            continue
        bins = sum(n * (1 + 2 ** (split + max(own - c, 0))) for own, n in held.items())
        if bins <= 2 * (1 + 2**split) * sum(held.values()):
            return c
    return top


def under_water(bars: DataFrame) -> DataFrame:
    """The drawdowns of each symbol: from the first close below the highest so far to the last one before it is reached again.

    ``(symbol, start_date, end_date, peak_c, low_c, n_days, depth)``, ``depth`` as a share of the peak; one that has not
    ended yet ends at the newest bar. No shuffle beyond that of the bars by symbol.
    """
    day = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peaked = bars.select("symbol", "trade_date", "close_c", F.max("close_c").over(day).alias("peak_c"))
    at_peak = (F.col("close_c") >= F.col("peak_c")).cast("int")
    counted = peaked.withColumn("island", F.sum(at_peak).over(day)).where("close_c < peak_c")
    return counted.groupBy("symbol", "island").agg(
        F.min("trade_date").alias("start_date"),
        F.max("trade_date").alias("end_date"),
        F.max("peak_c").alias("peak_c"),
        F.min("close_c").alias("low_c"),
        F.count(F.lit(1)).alias("n_days"),
    ).select(
        "symbol", "start_date", "end_date", "peak_c", "low_c", "n_days",
        (F.col("low_c").cast("double") / F.nullif(F.col("peak_c"), F.lit(0)).cast("double") - 1).alias("depth"),
    )
