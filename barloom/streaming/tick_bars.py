"""Daily bars kept up to date from a stream of ticks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import BAR_COLUMNS, BAR_VALUES, KEY
from barloom.functions.columns import to_cents, utc_instant

_DAY_MICROS = 86_400_000_000

EVENTS = (
    T.StructType()
    .add("event_id", "long")
    .add("ts", "timestamp_ntz")
    .add("user_id", "long")
    .add("event_type", "string")
    .add("value", "double")
    .add("props", "string")
)


def utc_day(instant: Column) -> Column:
    days = F.floor(F.unix_micros(instant) / F.lit(_DAY_MICROS)).cast("int")
    return F.date_from_unix_date(days)


def event_stream(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """Ticks ``(symbol, ts, price_c, seq)`` from the event files arriving in a folder.

    ``folder`` may be a glob, and what it matches a file or a directory of part files.
    """
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).select(
        F.col("event_type").alias("symbol"),
        utc_instant(F.col("ts")).alias("ts"),
        to_cents(F.col("value")).alias("price_c"),
        F.col("event_id").alias("seq"),
    )


def stream_daily_bars(ticks: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Bars of a tick stream. Ticks later than ``lateness`` behind the newest are dropped.

    State is one small aggregate per symbol and open day, combined on the map
    side, so a hot symbol costs no more than a quiet one.
    """
    day = F.window("ts", "1 day")
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy("symbol", day)
        .agg(
            F.min_by("price_c", "seq").alias("open_c"),
            F.max("price_c").alias("high_c"),
            F.min("price_c").alias("low_c"),
            F.max_by("price_c", "seq").alias("close_c"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("symbol", utc_day(F.col("window.start")).alias("trade_date"), *BAR_VALUES)
    )


def store_bars(bars: DataFrame, store: str) -> None:
    """Run the stream over all that is available, each batch's changed bars in a directory.

    Update mode, so days still open are stored too, and no result passes through
    the driver. A replayed batch overwrites its directory.
    """

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/bars/batch_id={batch_id}")

    (
        bars.writeStream.outputMode("update")
        .foreachBatch(store_batch)
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _partial() -> list[Column]:
    return [
        F.min_by("price_c", "seq").alias("open_c"),
        F.max("price_c").alias("high_c"),
        F.min("price_c").alias("low_c"),
        F.max_by("price_c", "seq").alias("close_c"),
        F.count(F.lit(1)).alias("volume"),
        F.min("seq").alias("open_seq"),
        F.max("seq").alias("close_seq"),
    ]


def store_partial_bars(ticks: DataFrame, store: str) -> None:
    """Reduce each batch of a tick stream to partial bars in a directory of its own.

    No watermark and no state: however the ticks are split into batches, and however
    late they come, ``combine_bars`` gives the same bars. A replayed batch overwrites
    its directory. Partial bars carry the order of their first and last tick.
    """

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        bars = batch.groupBy("symbol", utc_day(F.col("ts")).alias("trade_date")).agg(*_partial())
        bars.write.mode("overwrite").parquet(f"{store}/partial/batch_id={batch_id}")

    (
        ticks.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def combine_bars(spark: SparkSession, store: str) -> DataFrame:
    """The bars of all ticks stored so far, from the batches' partial bars."""
    return (
        spark.read.parquet(f"{store}/partial")
        .groupBy(*KEY)
        .agg(
            F.min_by("open_c", "open_seq").alias("open_c"),
            F.max("high_c").alias("high_c"),
            F.min("low_c").alias("low_c"),
            F.max_by("close_c", "close_seq").alias("close_c"),
            F.sum("volume").alias("volume"),
        )
        .select(*BAR_COLUMNS)
    )


def read_bars(spark: SparkSession, store: str) -> DataFrame:
    """Each bar as the newest batch that changed it left it."""
    newest = F.max(F.struct("batch_id", *BAR_VALUES)).alias("_newest")
    return (
        spark.read.parquet(f"{store}/bars")
        .groupBy(*KEY)
        .agg(newest)
        .select(*KEY, *[F.col(f"_newest.{name}").alias(name) for name in BAR_VALUES])
        .select(*BAR_COLUMNS)
    )
