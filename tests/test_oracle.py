"""Every registered query against its SQL in DuckDB, by schema, row count and value."""

import oracle
import pytest

import __spark_entry__ as entry
from barloom import plans

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small():
    return oracle.connect(SMALL)


@pytest.fixture(scope="module")
def medium():
    return oracle.connect(MEDIUM)


@pytest.mark.parametrize("name", plans.queries())
def test_matches_sql(spark, medium, name):
    df = entry.queries()[name](spark, MEDIUM)
    assert oracle.differences(df, medium, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize(
    "name", ["supplier_daily_bars", "walk_forward", "chart_correlation", "predict_close", "daily_ingest"]
)
def test_matches_sql_on_few_rows(spark, small, name):
    df = entry.queries()[name](spark, SMALL)
    assert oracle.differences(df, small, entry.oracle_sql()[name]) == []


def test_other_time_zone(spark, medium):
    """Days do not move with the session time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        for name in ["daily_bars", "weekly_bars", "stream_daily_bars", "calendar_fill", "csv_roundtrip"]:
            df = entry.queries()[name](spark, MEDIUM)
            assert oracle.differences(df, medium, entry.oracle_sql()[name]) == [], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "trade_date", "split", "label", "prediction"]
    assert df.where("split = 'forecast'").count() == 5
