"""Exponentially weighted measures over bars: recurrences, run as scans and not as frames."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import ratio, to_price
from barloom.functions.windows import by_day, so_far


def decayed(bars: DataFrame, name: str, value: Column, keep: float) -> DataFrame:
    """Adds ``name``: of each symbol, s = ``keep`` * (s of the bar before) + ``value``, from 0.

    A null value leaves s as it is; before the first value s is null.

    Each step is an affine map, and a run of steps is one too: multiply by a power of
    ``keep``, add. So the scan takes two passes: within blocks of bars s is a running sum of the
    values, scaled up by the power of ``keep`` that later steps take away; then each block gets what
    the one before ended with. Blocks are as long as the scale stays within 10^140, thousands of bars for
    usual decays; what a block before the last adds is under 10^-140 of it. The work per bar
    does not depend on ``keep``. Windows by symbol only: no shuffle beyond that of the bars.
    """
    if not 0 < keep < 1:
        raise ValueError("keep lies between 0 and 1")
    size = max(1, int(140 / -math.log10(keep)))
    seen = F.count("_value").over(so_far()) - 1
    numbered = bars.withColumn("_value", value).withColumn("_seen", seen)
    numbered = numbered.withColumns({"_block": F.floor(F.col("_seen") / size), "_at": F.pmod("_seen", F.lit(size))})
    in_block = Window.partitionBy("symbol", "_block").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    scaled = F.sum(F.col("_value") * F.pow(F.lit(keep), -F.col("_at"))).over(in_block)
    local = numbered.withColumn("_local", scaled * F.pow(F.lit(keep), F.col("_at")))
    known = F.col("_value").isNotNull()
    end = F.when(known & (F.col("_at") == size - 1), F.col("_local"))
    before = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.coalesce(F.last("_end", ignorenulls=True).over(before), F.lit(0.0))
    carried = local.withColumn("_end", end).withColumn("_carry", carry)
    state = F.when(known, F.col("_local") + F.pow(F.lit(keep), F.col("_at") + 1) * F.col("_carry"))
    whole = carried.withColumn("_state", state).withColumn(name, F.last("_state", ignorenulls=True).over(so_far()))
    return whole.drop("_value", "_seen", "_block", "_at", "_local", "_end", "_carry", "_state")


def _weighted(bars: DataFrame, name: str, value: Column, keep: float) -> DataFrame:
    """Adds the weighted mean m = ``keep`` * m + (1 - ``keep``) * value; the first value counts in full."""
    known = bars.withColumn("_x", value)
    first = F.count("_x").over(so_far()) == 1
    step = F.when(first, F.col("_x")).otherwise(F.col("_x") * (1 - keep))
    return decayed(known, name, step, keep).drop("_x")


def ew_mean(bars: DataFrame, *spans: int) -> DataFrame:
    """Adds ``ema_<span>`` for each span: the exponentially weighted mean close, weight 2 / (span + 1) on the newest."""
    for span in spans:
        bars = _weighted(bars, f"ema_{span}", to_price(F.col("close_c")), 1 - 2 / (span + 1))
    return bars


def ew_volatility(bars: DataFrame, keep: float = 0.94) -> DataFrame:
    """Adds ``ew_vol``: the root of the exponentially weighted mean square of daily returns; null at a symbol's first bar."""
    returns = bars.withColumn("_ret", ratio(F.col("close_c"), F.lag("close_c").over(by_day())) - 1)
    squares = _weighted(returns, "_square", F.col("_ret") * F.col("_ret"), keep)
    return squares.withColumn("ew_vol", F.sqrt("_square")).drop("_ret", "_square")


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Adds ``macd``, the fast less the slow mean close, and ``macd_signal``, its own weighted mean."""
    both = ew_mean(bars, fast, slow)
    apart = both.withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
    return _weighted(apart, "macd_signal", F.col("macd"), 1 - 2 / (signal + 1))
