"""Per-symbol price measures over daily bars.

Each function takes bars (one row per symbol and day) and adds columns. All
windows share one partitioning and order, so chaining several functions still
costs one shuffle and one sort.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import (
    day_of_week,
    exact,
    mean_price,
    ratio,
    sd_price,
    square,
    to_price,
)
from barloom.functions.windows import by_day, so_far, trailing, trailing_total


def daily_return(bars: DataFrame) -> DataFrame:
    """Adds ``ret``: close / previous close - 1."""
    return bars.withColumn("ret", ratio(F.col("close_c"), F.lag("close_c").over(by_day())) - 1)


def log_return(bars: DataFrame) -> DataFrame:
    """Adds ``log_ret``, rounded to 9 places; null unless both closes are positive."""
    growth = ratio(F.col("close_c"), F.lag("close_c").over(by_day()))
    return bars.withColumn("log_ret", F.when(growth > 0, F.round(F.ln(growth), 9)))


def moving_average(bars: DataFrame, *rows: int) -> DataFrame:
    """Adds ``sma_<n>`` for each n: mean close of the last n bars (fewer at the start)."""
    totals = bars.withColumns(
        {"_n": F.count("close_c").over(so_far()), "_total": F.sum("close_c").over(so_far())}
    )
    means = {
        f"sma_{n}": ratio(trailing_total("_total", n), trailing_total("_n", n)) / 100 for n in rows
    }
    return totals.withColumns(means).drop("_n", "_total")


def rolling_volatility(bars: DataFrame, rows: int = 20) -> DataFrame:
    """Adds ``sd_<n>``: sample standard deviation of the last n closes."""
    close = F.col("close_c")
    totals = bars.withColumns(
        {
            "_n": F.count(close).over(so_far()),
            "_total": F.sum(exact(close)).over(so_far()),
            "_squares": F.sum(square(close)).over(so_far()),
        }
    )
    moments = ["_n", "_total", "_squares"]
    return (
        totals.withColumns({name: trailing_total(name, rows) for name in moments})
        .withColumn(f"sd_{rows}", sd_price(*[F.col(name) for name in moments]))
        .drop(*moments)
    )


#: Longer windows than this are measured by blocks.
FRAME = 64


def _trailing_extremes(bars: DataFrame, rows: int) -> DataFrame:
    """Adds ``range_high_c`` and ``range_low_c`` of the last ``rows`` bars, at a cost that doesn't grow with ``rows``.

    Bars are numbered and cut in blocks of ``rows``. The last ``rows`` bars are the end of one
    block and the beginning of the next: the extremes from a bar to its block's end, as they were
    ``rows`` - 1 bars ago, and those from the block's beginning to the bar. Both run along once.
    """
    numbered = bars.withColumn("_block", F.floor((F.row_number().over(by_day()) - 1) / rows))
    forth = Window.partitionBy("symbol", "_block").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("symbol", "_block").orderBy(F.desc("trade_date")).rowsBetween(Window.unboundedPreceding, 0)
    measured = numbered.withColumns(
        {
            "_high_on": F.max("high_c").over(back),
            "_low_on": F.min("low_c").over(back),
            "_high": F.max("high_c").over(forth),
            "_low": F.min("low_c").over(forth),
        }
    )

    def ago(name: str):
        return F.lag(name, rows - 1).over(by_day())

    return measured.withColumns(
        {"range_high_c": F.greatest("_high", ago("_high_on")), "range_low_c": F.least("_low", ago("_low_on"))}
    ).drop("_block", "_high_on", "_low_on", "_high", "_low")


def rolling_high_low(bars: DataFrame, rows: int = 20) -> DataFrame:
    """Adds the high and low of the last n bars and the close's position between them.

    A short window is a sliding frame, whose cost per bar grows with its length; a long one goes by blocks.
    """
    if rows > FRAME:
        measured = _trailing_extremes(bars, rows)
    else:
        frame = trailing(rows)
        measured = bars.withColumns(
            {
                "range_high_c": F.max("high_c").over(frame),
                "range_low_c": F.min("low_c").over(frame),
            }
        )
    return measured.withColumn(
        "range_position",
        ratio(F.col("close_c") - F.col("range_low_c"), F.col("range_high_c") - F.col("range_low_c")),
    )


def indexed_close(bars: DataFrame) -> DataFrame:
    """Adds ``index_100``: close rebased to 100 at the symbol's first bar."""
    first = F.first("close_c").over(so_far())
    return bars.withColumn("index_100", ratio(F.col("close_c"), first) * 100)


def drawdown(bars: DataFrame) -> DataFrame:
    """Adds the running peak close and ``drawdown``: close / peak - 1."""
    return bars.withColumn("peak_c", F.max("close_c").over(so_far())).withColumn(
        "drawdown", ratio(F.col("close_c"), F.col("peak_c")) - 1
    )


def date_gaps(bars: DataFrame, limit_days: int = 4) -> DataFrame:
    """Adds days since the previous bar and a flag where they exceed the limit."""
    return bars.withColumn(
        "gap_days", F.datediff("trade_date", F.lag("trade_date").over(by_day())).cast("int")
    ).withColumn("is_gap", F.coalesce(F.col("gap_days") > limit_days, F.lit(False)))


def calendar_fill(bars: DataFrame) -> DataFrame:
    """Every calendar day from a symbol's first to its last bar, last close carried forward.

    Each bar is exploded over the days up to the next bar. That gives what a
    join to a calendar followed by a carry-forward gives, in one shuffle.
    """
    next_day = F.lead("trade_date").over(by_day())
    until = F.coalesce(F.date_sub(next_day, 1), F.col("trade_date"))
    return bars.select(
        "symbol", F.col("trade_date").alias("bar_date"), until.alias("until"), "close_c"
    ).select(
        "symbol",
        F.explode(F.sequence("bar_date", "until")).alias("trade_date"),
        "close_c",
        "bar_date",
    ).select(
        "symbol", "trade_date", "close_c", (F.col("trade_date") != F.col("bar_date")).alias("filled")
    )


def top_movers(bars: DataFrame, k: int = 3) -> DataFrame:
    """The k symbols with the highest return of each day, ties broken by symbol.

    The rank filter lets Spark keep only k rows per day on each map task before
    the shuffle, so a day with very many symbols does not move whole.
    """
    best = Window.partitionBy("trade_date").orderBy(F.desc("ret"), F.asc("symbol"))
    return (
        daily_return(bars)
        .where(F.col("ret").isNotNull())
        .select("trade_date", "symbol", "ret", F.row_number().over(best).alias("place"))
        .where(F.col("place") <= k)
    )


def summary_stats(bars: DataFrame) -> DataFrame:
    """Count, range, mean, sample deviation and exact quartiles of close, per symbol."""
    close = F.col("close_c")
    quartiles = F.percentile(close, [0.25, 0.5, 0.75])
    return bars.groupBy("symbol").agg(
        F.count(close).alias("n"),
        to_price(F.min(close)).alias("min_close"),
        to_price(F.max(close)).alias("max_close"),
        mean_price(close).alias("mean_close"),
        sd_price(F.count(close), F.sum(exact(close)), F.sum(square(close))).alias("sd_close"),
        quartiles.alias("_q"),
    ).select(
        "symbol", "n", "min_close", "max_close", "mean_close", "sd_close",
        *[(F.col("_q")[i] / 100).alias(f"q{i + 1}_close") for i in range(3)],
    )


def _mean_return(returns: DataFrame, *keys) -> DataFrame:
    return (
        returns.where(F.col("ret").isNotNull())
        .groupBy(*keys)
        .agg(F.count("ret").alias("n"), F.round(F.avg("ret"), 9).alias("mean_ret"))
    )


def weekday_effect(bars: DataFrame) -> DataFrame:
    """Mean return by weekday (0 = Monday) and symbol."""
    return _mean_return(daily_return(bars), "symbol", day_of_week(F.col("trade_date")).alias("weekday"))


def month_effect(bars: DataFrame) -> DataFrame:
    """Mean return by calendar month and symbol."""
    return _mean_return(
        daily_return(bars), "symbol", F.month("trade_date").cast("int").alias("month")
    )


def true_range(bars: DataFrame) -> DataFrame:
    """Adds the greatest of high-low, |high - previous close| and |low - previous close|."""
    previous = F.lag("close_c").over(by_day())
    return bars.withColumn(
        "true_range_c",
        F.greatest(
            F.col("high_c") - F.col("low_c"),
            F.abs(F.col("high_c") - previous),
            F.abs(F.col("low_c") - previous),
        ),
    )


def volume_stats(bars: DataFrame, rows: int = 20, spike: float = 2.0) -> DataFrame:
    """Adds the mean volume of the last n bars, the ratio to it and a spike flag."""
    totals = bars.withColumns(
        {"_n": F.count("volume").over(so_far()), "_total": F.sum("volume").over(so_far())}
    )
    mean = ratio(trailing_total("_total", rows), trailing_total("_n", rows))
    return (
        totals.withColumn("mean_volume", mean)
        .drop("_n", "_total")
        .withColumn("volume_ratio", ratio(F.col("volume"), F.col("mean_volume")))
        .withColumn("is_spike", F.coalesce(F.col("volume_ratio") >= spike, F.lit(False)))
    )
