"""Ticks to daily bars, and daily bars to longer periods."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bars(ticks: DataFrame) -> DataFrame:
    """Ticks ``(symbol, trade_date, price_c, seq)`` to one bar per symbol and day.

    ``seq`` orders the ticks inside a day and must be unique there. A number or
    time is aggregated by hash (``wide_key`` makes one of two); a struct would be
    sorted. The shuffle is on ``(symbol, trade_date)`` and carries partial
    aggregates only, so a symbol holding a third of all ticks is spread over its
    days and its ticks never travel. Volume is the number of ticks.
    """
    return ticks.groupBy("symbol", "trade_date").agg(
        F.min_by("price_c", "seq").alias("open_c"),
        F.max("price_c").alias("high_c"),
        F.min("price_c").alias("low_c"),
        F.max_by("price_c", "seq").alias("close_c"),
        F.count(F.lit(1)).alias("volume"),
    )


def resample(bars: DataFrame, unit: str) -> DataFrame:
    """Daily bars to ``unit`` bars ("week" starts on Monday, or "month", "quarter", "year")."""
    return bars.groupBy("symbol", F.trunc("trade_date", unit).alias("period_start")).agg(
        F.min_by("open_c", "trade_date").alias("open_c"),
        F.max("high_c").alias("high_c"),
        F.min("low_c").alias("low_c"),
        F.max_by("close_c", "trade_date").alias("close_c"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("n_days"),
    )
