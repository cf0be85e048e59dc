"""Column expressions that give the same value whatever the row order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EXACT = "decimal(38,0)"


def to_cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def to_price(cents: Column) -> Column:
    return cents.cast("double") / 100


def wide_key(high: Column, low: Column) -> Column:
    """Two non-negative bigints as one number that sorts by ``high``, then ``low``.

    Of fixed width, so aggregates ordered by it run by hash; ordered by a struct,
    Spark would sort the rows.
    """
    shift = F.lit("1" + "0" * 19).cast("decimal(20,0)")  # above the largest bigint
    return high.cast("decimal(19,0)") * shift + low.cast("decimal(19,0)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def mean_price(cents: Column, window=None) -> Column:
    """Mean of integer cents, as a price. The sum is exact, so the mean does
    not depend on the order rows arrive in."""
    total, n = F.sum(cents), F.count(cents)
    if window is not None:
        total, n = total.over(window), n.over(window)
    return ratio(total, n) / 100


def exact(cents: Column) -> Column:
    """Wide enough for sums of squares."""
    return cents.cast(_EXACT)


def square(cents: Column) -> Column:
    return (exact(cents) * exact(cents)).cast(_EXACT)


def sd_price(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation, as a price, from count, sum and sum of squares in cents.

    The moments are exact integers: a floating-point variance would change in its
    last digits with the order of the rows. Null for fewer than two rows.
    """
    n = n.cast("decimal(18,0)")
    spread = (n * squares - total * total).cast("double")
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double")) / 100)


def day_of_week(day: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(day).cast("int")


def round_columns(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})


def utc_instant(local: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session time zone.

    Watermarks need an instant, and a day must not move with the session."""
    return F.timestamp_add(
        "MICROSECOND",
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), local),
        F.lit("1970-01-01 00:00:00Z").cast("timestamp"),
    )
