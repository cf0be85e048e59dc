"""Bars as they were known: each state of a bar with the dates between which it was the newest fetched."""

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import BAR_COLUMNS, BAR_VALUES, BARS, KEY

#: ``known_to`` is the first day on which the state no longer held; null while it holds.
VERSIONS = T.StructType(
    [*BARS.fields, T.StructField("known_from", T.DateType()), T.StructField("known_to", T.DateType())]
)


def versions(fetched: DataFrame, *prefer: str) -> DataFrame:
    """All states of all bars, from bars with ``fetch_date``.

    Of a bar fetched several times on a date, the first by the ``prefer`` columns counts, then by
    its values. A fetch that brings what was known already makes no new state; a fetch without the bar
    leaves it as it was. Rows without a date are left out, as nothing says when they were known.

    Repeats within a date combine on the map side; the window holds one bar's fetches, a row per date at most.
    """
    first = F.min(F.struct(*prefer, *BAR_VALUES)).alias("state")
    dated = fetched.where(F.col("fetch_date").isNotNull()).groupBy(*KEY, "fetch_date").agg(first)
    dated = dated.select(*KEY, "fetch_date", F.struct(*[F.col(f"state.{name}") for name in BAR_VALUES]).alias("state"))
    by_fetch = Window.partitionBy(*KEY).orderBy("fetch_date")
    changed = ~F.col("state").eqNullSafe(F.lag("state").over(by_fetch))
    changes = dated.withColumn("changed", changed).where("changed")
    return changes.withColumn("known_to", F.lead("fetch_date").over(by_fetch)).select(
        *KEY, "state.*", F.col("fetch_date").alias("known_from"), "known_to"
    )


def extend(known: DataFrame, fetched: DataFrame, *prefer: str) -> DataFrame:
    """``versions`` of all fetches, from those of the fetches so far and bars fetched since.

    Only states that still hold meet the new bars; closed ones pass through. Every
    ``fetch_date`` in ``fetched`` must be later than all that ``known`` was made from: an earlier one can
    reopen a closed state, which only a replay of that bar's fetches shows.
    """
    still = known.where(F.col("known_to").isNull()).select(*BAR_COLUMNS, F.col("known_from").alias("fetch_date"))
    told_apart = [F.lit(None).cast(fetched.schema[name].dataType).alias(name) for name in prefer]
    again = still.select("*", *told_apart).unionByName(fetched.select(*BAR_COLUMNS, "fetch_date", *prefer))
    return known.where(F.col("known_to").isNotNull()).unionByName(versions(again, *prefer))


def as_known(known: DataFrame, day: Column | datetime.date) -> DataFrame:
    """The bars as someone saw them on ``day``: a filter on stored versions."""
    day = day if isinstance(day, Column) else F.lit(day)
    holds = (F.col("known_from") <= day) & (F.col("known_to").isNull() | (F.col("known_to") > day))
    return known.where(holds).select(*BAR_COLUMNS)


def revisions(known: DataFrame) -> DataFrame:
    """Each state that replaced another: (symbol, trade_date, known_from, old_close_c, close_c, days_held)."""
    by_state = Window.partitionBy(*KEY).orderBy("known_from")
    told = known.withColumns(
        {"old_close_c": F.lag("close_c").over(by_state), "since": F.lag("known_from").over(by_state)}
    )
    return told.where(F.col("since").isNotNull()).select(
        *KEY, "known_from", "old_close_c", "close_c", F.datediff("known_from", "since").alias("days_held")
    )
