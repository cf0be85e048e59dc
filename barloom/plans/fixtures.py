"""Snapshots, faulty CSV and fetched bodies that Spark derives from the bars."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import day_of_week

OLD_FETCH = datetime.date(2001, 1, 1)
NEW_FETCH = datetime.date(2002, 1, 1)
BROKEN_FETCH = datetime.date(2003, 1, 1)


def old_snapshot(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("trade_date") <= F.lit("2000-12-31").cast("date"))


def new_snapshot(bars: DataFrame) -> DataFrame:
    """From mid-2000 on, with every Friday's prices restated by a cent."""
    return restated(bars.where(F.col("trade_date") >= F.lit("2000-06-01").cast("date")))


def restated(bars: DataFrame) -> DataFrame:
    """Every Friday's prices a cent higher."""
    cent = F.when(day_of_week(F.col("trade_date")) == 4, 1).otherwise(0)
    return bars.withColumns(
        {name: F.col(name) + cent for name in ["open_c", "high_c", "low_c", "close_c"]}
    )


def _text(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("string")


def _line(day: Column, high: Column, close: Column, volume: Column) -> Column:
    return F.concat_ws(
        ",", day, _text(F.col("open_c")), high, _text(F.col("low_c")), close, volume.cast("string")
    )


def _numbered(bars: DataFrame, lines: Column) -> DataFrame:
    """Lines with the year end as fetch date; ``line_no`` orders them inside a body."""
    return bars.select(
        "symbol",
        F.make_date(F.year("trade_date"), F.lit(12), F.lit(31)).alias("fetch_date"),
        "trade_date",
        F.posexplode(lines).alias("copy", "line"),
    ).select(
        "symbol", "fetch_date", (F.unix_date("trade_date") * 2 + F.col("copy")).alias("line_no"), "line"
    )


def clean_lines(bars: DataFrame) -> DataFrame:
    day, close = F.col("trade_date").cast("string"), _text(F.col("close_c"))
    return _numbered(bars, F.array(_line(day, _text(F.col("high_c")), close, F.col("volume"))))


def faulty_lines(bars: DataFrame) -> DataFrame:
    """Every bar as a CSV line, with a fault that depends on the day of the month:
    3 bad date, 6 empty close, 9 high below low, 12 close above high, 15 negative
    volume, 18 the line twice, 21 a second line with another close."""
    dom = F.dayofmonth("trade_date")
    day = F.when(dom == 3, "n/a").otherwise(F.col("trade_date").cast("string"))
    high = F.when(dom == 9, _text(F.col("low_c") - 1)).otherwise(_text(F.col("high_c")))
    close = (
        F.when(dom == 6, "")
        .when(dom == 12, _text(F.col("high_c") + 1))
        .otherwise(_text(F.col("close_c")))
    )
    volume = F.when(dom == 15, -F.col("volume")).otherwise(F.col("volume"))
    line = _line(day, high, close, volume)
    corrected = _line(day, high, _text(F.col("open_c")), volume)
    lines = (
        F.when(dom == 18, F.array(line, line)).when(dom == 21, F.array(line, corrected)).otherwise(F.array(line))
    )
    return _numbered(bars, lines)


def snapshot_lines(bars: DataFrame, fetch_date: datetime.date) -> DataFrame:
    """Every bar as a sound CSV line of one fetch."""
    high, close = _text(F.col("high_c")), _text(F.col("close_c"))
    return bars.select(
        "symbol",
        F.lit(fetch_date).alias("fetch_date"),
        F.unix_date("trade_date").alias("line_no"),
        _line(F.col("trade_date").cast("string"), high, close, F.col("volume")).alias("line"),
    )


def error_bodies(bars: DataFrame) -> DataFrame:
    """A fetch that came back with an error message in place of prices, for every symbol."""
    return bars.select(
        "symbol", F.lit("2002-12-31").cast("date").alias("fetch_date")
    ).distinct().withColumn("body", F.lit('{"message": "no data for this call"}'))
