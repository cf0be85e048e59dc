"""Quantile sketches kept per day and merged to longer periods, in place of going back to the ticks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketch size: of 99 in 100 quantiles, the rank is within ``RANK_ERROR`` of the one asked for, whatever the number of ticks.
K = 400
RANK_ERROR = 0.01


def daily_sketches(ticks: DataFrame, k: int = K) -> DataFrame:
    """(symbol, trade_date, n_ticks, sketch) of ticks (symbol, trade_date, price_c): a few kilobytes a day at most.

    Sketches are made on the map side and merged, so a symbol and day with a third of all ticks
    sends a sketch a task. Ticks without a price are not counted.
    """
    return ticks.groupBy("symbol", "trade_date").agg(
        F.count("price_c").alias("n_ticks"), F.kll_sketch_agg_bigint("price_c", k).alias("sketch")
    )


def roll_up(sketches: DataFrame, unit: str) -> DataFrame:
    """Sketches of days (or shorter periods) merged to (symbol, period_start, n_ticks, sketch) of ``unit`` periods."""
    day = "trade_date" if "trade_date" in sketches.columns else "period_start"
    return sketches.groupBy("symbol", F.trunc(day, unit).alias("period_start")).agg(
        F.sum("n_ticks").alias("n_ticks"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )


def quantiles(sketches: DataFrame, *ranks: float) -> DataFrame:
    """The sketches' periods with ``q<percent>_c`` for each rank, a price that was paid; null for a period without ticks."""
    others = [name for name in sketches.columns if name != "sketch"]
    asked = F.when(F.col("n_ticks") > 0, F.col("sketch"))
    found = [F.kll_sketch_get_quantile_bigint(asked, F.lit(rank)).alias(f"q{round(rank * 100)}_c") for rank in ranks]
    return sketches.select(*others, *found)


def rank_errors(ticks: DataFrame, found: DataFrame, unit: str, *ranks: float) -> DataFrame:
    """How far the ranks of ``quantiles`` are off, by counting the ticks: ``e<percent>`` beside each period.

    A price paid many times has a range of ranks; the error is the distance to that range.
    """
    period = F.trunc("trade_date", unit).alias("period_start")
    names = {rank: f"{round(rank * 100)}" for rank in ranks}
    each = ticks.select("symbol", period, "price_c").join(found.drop("n_ticks"), ["symbol", "period_start"])
    n = F.count("price_c")
    errors = []
    for rank, name in names.items():
        below = F.count(F.when(F.col("price_c") < F.col(f"q{name}_c"), 1)) / n
        upto = F.count(F.when(F.col("price_c") <= F.col(f"q{name}_c"), 1)) / n
        errors.append(F.greatest(below - rank, rank - upto, F.lit(0.0)).alias(f"e{name}"))
    return each.groupBy("symbol", "period_start").agg(n.alias("n_ticks"), *errors)
