"""The given Parquet tables, and bars and ticks derived from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.columns import to_cents, wide_key
from barloom.operators.bars import daily_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ticks: a symbol per priority, one tick per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        to_cents(F.col("o_totalprice")).alias("price_c"),
        F.col("o_orderkey").alias("seq"),
    )


def supplier_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticks: a symbol per supplier, so many symbols.

    Ordered by order, line (a digit), part and price (up to 8 digits of cents).
    """
    price_c = to_cents(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        price_c.alias("price_c"),
        wide_key(
            F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            F.col("l_partkey") * 100_000_000 + price_c,
        ).alias("seq"),
    )


def event_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks with their time, a symbol per event type."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("date").alias("trade_date"),
        to_cents(F.col("value")).alias("price_c"),
        F.col("event_id").alias("seq"),
        "ts",
    )


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(order_ticks(spark, sf_dir))


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(supplier_ticks(spark, sf_dir))
