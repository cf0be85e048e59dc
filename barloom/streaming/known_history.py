"""The history of a daily store as it was known on any past day.

Kept beside the store's newest history, in ``versions``, a directory per version and period, and
``versioned``, which notes the version of each period and the newest fetch in it.
"""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import bitemporal
from barloom.operators.quality import to_bars
from barloom.schemas import BAR_COLUMNS
from barloom.streaming.daily_ingest import read_if_there, read_rows

_NOTED = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("period", T.DateType()),
        T.StructField("through", T.DateType()),
    ]
)


def _newest(spark: SparkSession, store: str) -> dict[datetime.date, tuple[int, datetime.date | None]]:
    """(version, newest fetch in it) of each period; at most as many as the calendar has months."""
    noted = read_if_there(spark, _NOTED, f"{store}/versioned")
    last = noted.groupBy("period").agg(F.max(F.struct("batch_id", "through")).alias("last"))
    return {row["period"]: (row["last"]["batch_id"], row["last"]["through"]) for row in last.collect()}


def _read(spark: SparkSession, store: str, held: dict[datetime.date, int]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], bitemporal.VERSIONS)
    paths = [f"{store}/versions/version={version}/period={first}" for first, version in sorted(held.items())]
    return spark.read.schema(bitemporal.VERSIONS).parquet(*paths)


def read_versions(spark: SparkSession, store: str) -> DataFrame:
    """Every state of every bar, with the dates it was known between."""
    return _read(spark, store, {period: version for period, (version, _) in _newest(spark, store).items()})


def read_known(spark: SparkSession, store: str, day: datetime.date) -> DataFrame:
    """The history as ``read_history`` would have given it after the fetches up to ``day``."""
    return bitemporal.as_known(read_versions(spark, store), day)


def refresh_known(spark: SparkSession, store: str, period: str = "year") -> None:
    """Take the batches stored since the last refresh into the versions; call it after each daily run.

    Periods without news keep their version. Where all new fetches are later than those
    known, open states are closed or kept and the closed ones copied; where one is not, the period's
    versions are made anew from all its stored rows, as a late fetch may reopen a state. A new
    version counts once one small write has noted it, so a refresh that broke off is done again by
    the next and readers see the old one until then. Only periods and their dates come to the driver.
    """
    label = F.trunc("trade_date", period)
    newest = _newest(spark, store)
    sound = read_rows(spark, store).where("is_ok")
    since = max((version for version, _ in newest.values()), default=-1)
    new = sound.where(F.col("batch_id") > F.lit(since))
    news = new.groupBy(label.alias("period")).agg(
        F.max("batch_id").alias("batch_id"), F.min("fetch_date").alias("first"), F.max("fetch_date").alias("last")
    ).collect()
    news = [row for row in news if row["last"] is not None or row["period"] in newest]  # rows without a date are no version
    if not news:
        return
    version = max(row["batch_id"] for row in news)
    early, late, through = [], [], {}
    for row in news:
        before = newest.get(row["period"], (None, None))[1]
        replay = before is not None and row["first"] is not None and row["first"] <= before
        (late if replay else early).append(row["period"])
        through[row["period"]] = max((day for day in (before, row["last"]) if day is not None), default=None)

    prefer = ["source_file"]
    held = _read(spark, store, {p: newest[p][0] for p in early if p in newest})
    fresh = to_bars(new.where(label.isin(early)), "fetch_date", *prefer)
    made = bitemporal.extend(held, fresh, *prefer)
    if late:
        made = made.unionByName(bitemporal.versions(to_bars(sound.where(label.isin(late)), "fetch_date", *prefer), *prefer))
    (
        made.select(*BAR_COLUMNS, "known_from", "known_to", label.alias("period"))
        .hint("rebalance", "period")
        .write.mode("overwrite")
        .partitionBy("period")
        .parquet(f"{store}/versions/version={version}")
    )
    rows = [(version, row["period"], through[row["period"]]) for row in news]
    spark.createDataFrame(rows, _NOTED).coalesce(1).write.mode("append").parquet(f"{store}/versioned")
