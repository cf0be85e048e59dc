"""Sessions: runs of a symbol's ticks with no pause of over ``gap`` between neighbours."""

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.columns import utc_instant, wide_key

#: A session, or the part of one that falls to a slice or batch of ticks.
PARTS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        *[
            T.StructField(name, T.LongType())
            for name in ["start_us", "end_us", "open_c", "high_c", "low_c", "close_c", "n_ticks"]
        ],
        T.StructField("open_key", T.DecimalType(38, 0)),
        T.StructField("close_key", T.DecimalType(38, 0)),
    ]
)
_SHOWN = ["symbol", "start_us", "end_us", "open_c", "high_c", "low_c", "close_c", "n_ticks"]


def micros(ticks: DataFrame) -> Column:
    """A tick's time as microseconds since 1970 in UTC; one without a zone is read as UTC."""
    local = isinstance(ticks.schema["ts"].dataType, T.TimestampNTZType)
    return F.unix_micros(utc_instant(F.col("ts")) if local else F.col("ts"))


def _microseconds(gap: datetime.timedelta) -> int:
    return gap // datetime.timedelta(microseconds=1)


def parts(ticks: DataFrame, gap: datetime.timedelta) -> DataFrame:
    """The sessions within each symbol and day of ``ticks`` (symbol, ts, price_c, seq), from 1970 on.

    ``seq`` orders ticks of one time. Ticks meet by symbol and day, so a symbol with a third of
    them is sorted by a task a day. Of a day's sessions none is nearer than ``gap`` to the next, so there are a
    day's length over ``gap`` of them at most. Ticks without symbol or time are in no session.
    """
    known = ticks.where(F.col("symbol").isNotNull() & F.col("ts").isNotNull())
    timed = known.select("symbol", "price_c", "seq", micros(ticks).alias("us"))
    timed = timed.withColumn("slice", F.floor(F.col("us") / 86_400_000_000))
    along = Window.partitionBy("symbol", "slice").orderBy("us")
    opens = F.coalesce(F.col("us") - F.lag("us").over(along) > _microseconds(gap), F.lit(True))
    numbered = timed.withColumn("opens", opens.cast("int")).withColumn(
        "island", F.sum("opens").over(along.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    )
    keyed = numbered.withColumn("key", wide_key(F.col("us"), F.col("seq")))
    return keyed.groupBy("symbol", "slice", "island").agg(
        F.min("us").alias("start_us"),
        F.max("us").alias("end_us"),
        F.min_by("price_c", "key").alias("open_c"),
        F.max("price_c").alias("high_c"),
        F.min("price_c").alias("low_c"),
        F.max_by("price_c", "key").alias("close_c"),
        F.count(F.lit(1)).alias("n_ticks"),
        F.min("key").alias("open_key"),
        F.max("key").alias("close_key"),
    ).select([field.name for field in PARTS])


def merge(found: DataFrame, gap: datetime.timedelta) -> DataFrame:
    """Parts of sessions, from any slices and batches, as whole sessions.

    Parts no further than ``gap`` apart, or that overlap, are one session: between two neighbouring
    ticks of a part no pause is as long, so a tick of another part that lies there joins them too.
    A window sees a symbol's parts, not its ticks.
    """
    along = Window.partitionBy("symbol").orderBy("start_us", "end_us")
    reached = F.max("end_us").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start_us") - reached > _microseconds(gap), F.lit(True))
    numbered = found.withColumn("opens", opens.cast("int")).withColumn(
        "island", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy("symbol", "island").agg(
        F.min("start_us").alias("start_us"),
        F.max("end_us").alias("end_us"),
        F.min_by("open_c", "open_key").alias("open_c"),
        F.max("high_c").alias("high_c"),
        F.min("low_c").alias("low_c"),
        F.max_by("close_c", "close_key").alias("close_c"),
        F.sum("n_ticks").alias("n_ticks"),
    ).select(_SHOWN)


def sessions(ticks: DataFrame, gap: datetime.timedelta) -> DataFrame:
    """(symbol, start_us, end_us, open_c, high_c, low_c, close_c, n_ticks) of each session.

    Start and end are the first and last tick's microseconds since 1970. A pause of exactly ``gap`` ends no session, as in Spark's ``session_window``.
    """
    return merge(parts(ticks, gap), gap)
