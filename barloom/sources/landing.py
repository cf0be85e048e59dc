"""Bars landed as Parquet, a directory per symbol."""

from pyspark.sql import DataFrame, SparkSession

from barloom.schemas import BAR_COLUMNS, BARS


def land(bars: DataFrame, path: str) -> None:
    """Replace the symbols in ``bars``; other symbols stay as they are.

    Running it again gives the same table. Suited to some thousands of symbols;
    above that, land by date or by a hash bucket of the symbol.
    """
    (
        bars.select(*BAR_COLUMNS)
        .hint("rebalance", "symbol")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("symbol")
        .parquet(path)
    )


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BARS).parquet(path).select(*BAR_COLUMNS)


def buckets_for(bars: DataFrame, rows: int = 4_000_000) -> int:
    """Buckets of about ``rows`` bars (some 100 MB), at least one per core.

    Counts ``bars``, so give it a stored table, whose count is read from file footers.
    """
    return max(bars.sparkSession.sparkContext.defaultParallelism, -(-bars.count() // rows))


def save_bucketed(bars: DataFrame, table: str, path: str, buckets: int) -> None:
    """Replace a table of bars bucketed by symbol and sorted by day inside a bucket.

    Every per-symbol window over it, and every aggregate by symbol, then runs
    without a shuffle. One file per bucket: rows are gathered by symbol first.
    """
    (
        bars.select(*BAR_COLUMNS)
        .repartition(buckets, "symbol")
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "symbol")
        .sortBy("symbol", "trade_date")
        .saveAsTable(table)
    )


def append_runs(log: DataFrame, path: str) -> None:
    """Add run rows to the run table."""
    log.write.mode("append").parquet(path)
