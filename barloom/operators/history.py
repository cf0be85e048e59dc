"""Keeping a price history out of repeated snapshots."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import ratio
from barloom.schemas import BAR_COLUMNS, BAR_VALUES, KEY


def latest(rows: DataFrame, *version: str) -> DataFrame:
    """One bar per (symbol, trade_date): the one with the highest version columns.

    A ``max`` over a struct instead of a ranked window: it combines on the map
    side, so a key repeated in very many snapshots reaches its reducer as one row
    per map task. Equal versions are decided by the bar values, so the result
    does not depend on row order.
    """
    newest = F.max(F.struct(*version, *BAR_VALUES)).alias("_newest")
    return rows.groupBy(*KEY).agg(newest).select(
        *KEY, *[F.col(f"_newest.{name}").alias(name) for name in BAR_VALUES]
    )


def merge(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """History with the snapshot laid over it; the snapshot wins on equal keys."""
    older = history.select(*BAR_COLUMNS, F.lit(0).alias("_version"))
    newer = snapshot.select(*BAR_COLUMNS, F.lit(1).alias("_version"))
    return latest(older.unionByName(newer), "_version")


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every key of two snapshots as added, dropped, revised or same.

    Both sides hold a key once (see ``latest``), so the join key cannot be hot.
    """
    a, b = old.select(*BAR_COLUMNS).alias("a"), new.select(*BAR_COLUMNS).alias("b")
    unchanged = F.lit(True)
    for name in BAR_VALUES:
        unchanged = unchanged & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    status = (
        F.when(F.col("a.symbol").isNull(), "added")
        .when(F.col("b.symbol").isNull(), "dropped")
        .when(unchanged, "same")
        .otherwise("revised")
    )
    same_key = (F.col("a.symbol") == F.col("b.symbol")) & (
        F.col("a.trade_date") == F.col("b.trade_date")
    )
    return a.join(b, same_key, "full_outer").select(
        F.coalesce("a.symbol", "b.symbol").alias("symbol"),
        F.coalesce("a.trade_date", "b.trade_date").alias("trade_date"),
        status.alias("status"),
        F.col("a.close_c").alias("old_close_c"),
        F.col("b.close_c").alias("new_close_c"),
        (ratio(F.col("b.close_c"), F.col("a.close_c")) - 1).alias("close_change"),
    )
