"""Window specs over bars. All are partitioned by symbol, never global.

A window partition is one symbol's bars, at most one row per calendar day
(a century is about 36,000 rows), however many ticks the symbol has: ticks are
reduced to bars by an aggregate with map-side combine before any window runs.
"""

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def by_day() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("trade_date")


def trailing(rows: int) -> WindowSpec:
    """The last ``rows`` bars, the current one included."""
    return by_day().rowsBetween(-(rows - 1), Window.currentRow)


def so_far() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole_symbol() -> WindowSpec:
    return Window.partitionBy("symbol")


def trailing_total(running: str, rows: int) -> Column:
    """The part of a running total that falls to the last ``rows`` bars.

    The running total less what it was ``rows`` bars ago: the work per bar does
    not grow with ``rows``, as that of a sliding frame does. For whole numbers,
    where the difference is exact.
    """
    return F.col(running) - F.coalesce(F.lag(running, rows).over(by_day()), F.lit(0))
