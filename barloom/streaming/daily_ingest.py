"""The daily job: take in the files or fetched bodies that are new, then stop.

A store holds ``rows``, every row ever read with the verdict on it, a directory
per batch; ``current``, the history made from them, a directory per version and
period; ``refreshed``, the version of each period; ``runs``, a row per run; and,
if it is fed from bodies, ``bodies``, each as it was fetched.
"""

import contextlib
import datetime
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.quality import classify, run_log, to_bars
from barloom.schemas import BAR_COLUMNS, BAR_VALUES, BARS, CSV_HEADER, KEY
from barloom.sources.landing import append_runs
from barloom.sources.price_csv import (
    FILE_SCHEMA, Header, check_headers, check_named, parse_named_payloads, parse_payloads, stream_named, stream_scan,
)

# A batch stores the raw row, the verdict on it, and two partition columns.
_ROWS = T.StructType(
    [
        *FILE_SCHEMA.fields,
        T.StructField("source_file", T.StringType()),
        T.StructField("header_ok", T.BooleanType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("batch_id", T.LongType()),
        T.StructField("is_ok", T.BooleanType()),
    ]
)
# A bar of the history, with the fetch and file (or body) it comes from.
_SOURCE = ["fetch_date", "source_file"]
_CURRENT = T.StructType(
    [*BARS.fields, T.StructField("fetch_date", T.DateType()), T.StructField("source_file", T.StringType())]
)
_REFRESHED = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("period", T.DateType())])
_KEPT = T.StructType([T.StructField("period", T.StringType()), T.StructField("source", T.StringType())])
_BODY = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("fetch_date", T.DateType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)


def read_if_there(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """A Parquet table, empty if nothing was written to it yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_rows(spark: SparkSession, store: str) -> DataFrame:
    """Every row ever taken in, accepted or not."""
    return read_if_there(spark, _ROWS, f"{store}/rows")


def read_bodies(spark: SparkSession, store: str) -> DataFrame:
    """Every body ever taken in, as it was fetched."""
    return read_if_there(spark, _BODY, f"{store}/bodies")


def _versions(spark: SparkSession, store: str) -> dict[datetime.date, int]:
    """The version that holds each period; at most as many as the calendar has months."""
    noted = read_if_there(spark, _REFRESHED, f"{store}/refreshed")
    newest = noted.groupBy("period").agg(F.max("batch_id").alias("batch_id"))
    return {row["period"]: row["batch_id"] for row in newest.collect()}


def _read_current(spark: SparkSession, store: str, versions: dict[datetime.date, int]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], _CURRENT)
    paths = [f"{store}/current/version={version}/period={first}" for first, version in sorted(versions.items())]
    return spark.read.schema(_CURRENT).parquet(*paths)


def read_history(spark: SparkSession, store: str) -> DataFrame:
    """The history: of each (symbol, trade_date) the bar of the newest fetch."""
    return _read_current(spark, store, _versions(spark, store)).select(*BAR_COLUMNS)


def check_kept(spark: SparkSession, store: str, period: str, source: str) -> None:
    """Note a store's period and source on first use, and refuse others.

    Directories of another period would hide each other, and batches of another
    source would be numbered anew.
    """
    noted = read_if_there(spark, _KEPT, f"{store}/kept").first()
    if noted is None:
        spark.createDataFrame([(period, source)], _KEPT).coalesce(1).write.mode("append").parquet(f"{store}/kept")
    elif tuple(noted) != (period, source):
        raise ValueError(f"the store is kept by {noted.period} from {noted.source}, not by {period} from {source}")


def _path(spark: SparkSession, name: str):
    """A Hadoop path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextlib.contextmanager
def only_writer(spark: SparkSession, store: str, stale: datetime.timedelta = datetime.timedelta(days=1)):
    """Refuse a second writer while one is at work: two at once would write versions of the same number.

    The writer holds a file ``writer.lock`` that only one can make. One left behind by a run that was
    killed is taken over once it is older than ``stale``, so a run must not take longer. On object stores
    without an exclusive create, two that start in the same instant are not told apart.
    """
    path, files = _path(spark, f"{store}/writer.lock")
    if files.exists(path):
        age = time.time() - files.getFileStatus(path).getModificationTime() / 1000
        if age < stale.total_seconds():
            raise RuntimeError(f"{store} has had another writer for {age:.0f} seconds; if it is gone, delete writer.lock")
        files.delete(path, False)
    try:
        files.create(path, False).close()
    except Py4JJavaError as error:
        raise RuntimeError(f"{store} has another writer") from error
    try:
        yield
    finally:
        files.delete(path, False)


def vacuum(spark: SparkSession, store: str, grace: datetime.timedelta = datetime.timedelta(days=7)) -> int:
    """Delete versions of the history that were replaced over ``grace`` ago; how many there were.

    A reader that found a version before it was replaced may still hold it, so none is deleted
    sooner; ``grace`` must exceed the longest job that reads the history. Rows, bodies and newest versions stay. The
    time a version was replaced is that of the note of its successor.
    """
    noted = read_if_there(spark, _REFRESHED, f"{store}/refreshed")
    if not noted.inputFiles():
        return 0
    dated = noted.select("batch_id", "period", F.col("_metadata.file_modification_time").alias("noted_at"))
    after = Window.partitionBy("period").orderBy("batch_id")
    replaced = dated.withColumn("replaced_at", F.lead("noted_at").over(after)).where("replaced_at is not null")
    old = replaced.where(F.unix_micros("replaced_at") <= int((time.time() - grace.total_seconds()) * 1e6)).collect()
    deleted = 0
    for row in old:
        path, files = _path(spark, f"{store}/current/version={row['batch_id']}/period={row['period']}")
        deleted += files.delete(path, True)
    return deleted


def refresh_history(spark: SparkSession, store: str, period: str) -> None:
    """Make a new version of the periods in which batches since the last refresh have bars.

    It is made from those periods' versions so far and the new batches, so a run
    reads no older batch. Versions are never changed once noted: a reader sees
    the old ones until one small write notes the new, and a refresh that broke off is
    done again by the next run. ``vacuum`` deletes versions no longer noted. Only the first days of the periods come to the driver.
    """
    versions = _versions(spark, store)
    label = F.trunc("trade_date", period)
    new = read_rows(spark, store).where("is_ok").where(F.col("batch_id") > F.lit(max(versions.values(), default=-1)))
    news = new.groupBy(label.alias("period")).agg(F.max("batch_id").alias("batch_id")).collect()
    if not news:
        return
    newest = max(row["batch_id"] for row in news)
    touched = {row["period"]: versions[row["period"]] for row in news if row["period"] in versions}
    # Newest fetch first, one without a date last; then the first file by name, however the files came in batches.
    age = F.coalesce(-F.unix_date("fetch_date"), F.lit(2**31 - 1))
    first = F.min_by(F.struct(*BAR_VALUES, *_SOURCE), F.struct(age, "source_file"))
    bars = to_bars(new, *_SOURCE).unionByName(_read_current(spark, store, touched))
    (
        bars.groupBy(*KEY)
        .agg(first.alias("first"))
        .select(*KEY, "first.*", label.alias("period"))
        .hint("rebalance", "period")
        .write.mode("overwrite")
        .partitionBy("period")
        .parquet(f"{store}/current/version={newest}")
    )
    noted = spark.createDataFrame([(newest, row["period"]) for row in news], _REFRESHED)
    noted.coalesce(1).write.mode("append").parquet(f"{store}/refreshed")


def _ingest(
    stream: DataFrame, check: Callable[[DataFrame], DataFrame], store: str, period: str, written: list[int]
) -> list[int]:
    """Store what is new in a stream, checked, then refresh the history."""

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        (
            check(batch)
            .withColumn("is_ok", F.size("reasons") == 0)
            .sortWithinPartitions("is_ok", "trade_date")
            .write.mode("overwrite")
            .partitionBy("is_ok")
            .parquet(f"{store}/rows/batch_id={batch_id}")
        )
        written.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    refresh_history(stream.sparkSession, store, period)
    return written


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    store: str,
    max_files: int | None = None,
    period: str = "year",
    header: Header = CSV_HEADER,
    written: list[int] | None = None,
    by_name: bool = False,
) -> list[int]:
    """Check and store the files not seen before; returns the ids of the batches written.

    A batch is written in one pass, sound and rejected rows side by side, to a
    directory of its own that a replay overwrites. Together with the checkpoint
    every file counts exactly once. A file rewritten under its old name is not
    seen again, so landed names must be new for each fetch. After the batches,
    the history is refreshed by ``period`` ("year" or "month"; a store refuses another
    than its first). ``written``, if given, is filled as batches are stored, so a
    caller knows them even when the refresh breaks. ``by_name`` finds each file's columns by
    the names in its own header, in any order, in place of ``header``.
    """
    check_kept(spark, store, period, "files")

    def check(batch: DataFrame) -> DataFrame:
        rows = check_named(batch) if by_name else check_headers(batch)
        return classify(rows, order=["source_file"], fetch=["fetch_date"])

    stream = stream_named(spark, landing, max_files) if by_name else stream_scan(spark, landing, max_files, header)
    return _ingest(stream, check, store, period, [] if written is None else written)


def ingest_payloads(
    spark: SparkSession,
    payloads: DataFrame,
    store: str,
    period: str = "year",
    header: Header = CSV_HEADER,
    written: list[int] | None = None,
    by_name: bool = False,
) -> list[int]:
    """Keep fetched bodies as they are, then check and store their rows as ``ingest_new_files`` does.

    ``payloads`` has (symbol, fetch_date, body) and optionally ``status``, the
    response's. Bodies are appended to the store first and read from there by a
    stream, so one that was kept is taken in exactly once even if the run breaks. The rows of
    a body whose status is an error are rejected. Of rows that share a fetch and day, the
    first by the body's hash, then by line, is accepted. The same bodies
    given twice are kept and counted twice, and the history is the same.
    """
    check_kept(spark, store, period, "bodies")
    status = F.col("status").cast("int") if "status" in payloads.columns else F.lit(None).cast("int")
    kept = payloads.select("symbol", "fetch_date", status.alias("status"), "body")
    kept.write.mode("append").parquet(f"{store}/bodies")

    def check(batch: DataFrame) -> DataFrame:
        named = F.concat(F.lit("body:"), F.sha2(F.coalesce("body", F.lit("")), 256))
        bodies = batch.withColumn("source_file", named)
        rows = parse_named_payloads(bodies) if by_name else parse_payloads(bodies, header)
        return classify(rows, order=["source_file", "line_no"], fetch=["fetch_date"])

    stream = spark.readStream.schema(_BODY).parquet(f"{store}/bodies")
    return _ingest(stream, check, store, period, [] if written is None else written)


def _logged(
    spark: SparkSession,
    store: str,
    run_date: datetime.date,
    settings: dict[str, object],
    ingest: Callable[[list[int]], list[int]],
) -> str:
    """Run ``ingest`` and leave one row in the run table; a run that breaks is logged as failed, then raised."""
    missing = [name for name, value in ({"store": store, "run_date": run_date} | settings).items() if not value]
    if "store" in missing:  # nowhere to log it
        raise ValueError("required setting store is missing")
    run_id = uuid.uuid4().hex
    this_run = spark.createDataFrame([(run_id, run_date or None)], "run_id string, run_date date")
    runs = f"{store}/runs"
    batches: list[int] = []

    def account() -> DataFrame:
        rows = read_rows(spark, store).where(F.col("batch_id").isin(batches))
        return run_log(this_run, rows.withColumn("run_id", F.lit(run_id)))

    try:
        if missing:
            raise ValueError(f"required setting {missing[0]} is missing")
        with only_writer(spark, store):
            ingest(batches)
    except Exception as error:
        # What was stored before it broke counts for this run: the next one won't see it again.
        append_runs(
            account().withColumn("status", F.lit("failed")).withColumn("reason", F.lit(str(error))), runs
        )
        raise
    append_runs(account(), runs)
    return run_id


def run_daily(
    spark: SparkSession,
    landing: str,
    store: str,
    run_date: datetime.date,
    max_files: int | None = None,
    period: str = "year",
    header: Header = CSV_HEADER,
    by_name: bool = False,
) -> str:
    """One scheduled run over landed files; leaves one row in the run table and returns its run_id.

    Call it from any scheduler. A run that breaks is logged as failed, then raised.
    """
    return _logged(
        spark, store, run_date, {"landing": landing},
        lambda written: ingest_new_files(spark, landing, store, max_files, period, header, written, by_name),
    )


def run_payloads(
    spark: SparkSession,
    payloads: DataFrame,
    store: str,
    run_date: datetime.date,
    period: str = "year",
    header: Header = CSV_HEADER,
    by_name: bool = False,
) -> str:
    """``run_daily`` over fetched bodies."""
    return _logged(
        spark, store, run_date, {},
        lambda written: ingest_payloads(spark, payloads, store, period, header, written, by_name),
    )


def read_runs(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/runs")
