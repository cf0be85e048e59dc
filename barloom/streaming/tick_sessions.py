"""Sessions kept up to date from a stream of ticks."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import sessions
from barloom.streaming.daily_ingest import read_if_there

_STORED = T.StructType([*sessions.PARTS.fields, T.StructField("batch_id", T.LongType())])


def live_sessions(ticks: DataFrame, gap: datetime.timedelta, lateness: datetime.timedelta) -> DataFrame:
    """Sessions of a tick stream in Spark's own state, which merges those that a tick joins.

    In append mode a session comes out once no tick up to ``lateness`` late can touch it; later ones
    are dropped. Where none may be lost use ``store_sessions``.
    """
    seconds = [f"{span // datetime.timedelta(milliseconds=1)} milliseconds" for span in (lateness, gap)]
    us = F.unix_micros("ts")
    return (
        ticks.withWatermark("ts", seconds[0])
        .groupBy("symbol", F.session_window("ts", seconds[1]))
        .agg(
            F.min(us).alias("start_us"),
            F.max(us).alias("end_us"),
            F.min_by("price_c", F.struct("ts", "seq")).alias("open_c"),
            F.max("price_c").alias("high_c"),
            F.min("price_c").alias("low_c"),
            F.max_by("price_c", F.struct("ts", "seq")).alias("close_c"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
        .drop("session_window")
    )


def store_sessions(
    ticks: DataFrame, store: str, gap: datetime.timedelta, lateness: datetime.timedelta = datetime.timedelta(days=1)
) -> None:
    """Reduce each batch of a tick stream to parts of sessions, in a directory of its own.

    No state and nothing dropped: ``read_sessions`` merges the parts, however the ticks were split into
    batches and however late they came. Ticks more than ``lateness`` behind the newest of
    earlier batches are also listed in ``late``, since sessions read before then have changed. A
    replayed batch overwrites its directories.
    """
    spark = ticks.sparkSession

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        earlier = _parts(spark, store).where(F.col("batch_id") < batch_id)
        newest = earlier.agg(F.max("end_us")).first()[0]
        sessions.parts(batch, gap).write.mode("overwrite").parquet(f"{store}/parts/batch_id={batch_id}")
        behind = F.lit(False) if newest is None else sessions.micros(batch) < newest - lateness // datetime.timedelta(microseconds=1)
        late = batch.where(behind).select("symbol", "ts", "price_c", "seq")
        late.write.mode("overwrite").parquet(f"{store}/late/batch_id={batch_id}")

    (
        ticks.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _parts(spark: SparkSession, store: str) -> DataFrame:
    return read_if_there(spark, _STORED, f"{store}/parts")


def read_sessions(spark: SparkSession, store: str, gap: datetime.timedelta) -> DataFrame:
    """The sessions of all ticks stored so far."""
    return sessions.merge(_parts(spark, store).drop("batch_id"), gap)


def read_late(spark: SparkSession, store: str) -> DataFrame:
    """The ticks that came late, with the batch they came in."""
    return spark.read.parquet(f"{store}/late")
