"""Content checks on raw price rows, and the account of a run."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import to_cents
from barloom.schemas import BAR_COLUMNS, KEY

_PRICES = ["open", "high", "low", "close"]

# Rows that share one (symbol, trade_date) are first ranked inside this many
# slices, so a key holding a third of all rows is sorted by thousands of tasks.
SALTS = 1 << 16


def _outside(price: Column) -> Column:
    return (price < F.col("low")) | (price > F.col("high"))


def _row_reasons(columns: list[str]) -> Column:
    price_missing = not_positive = finer = F.lit(False)
    for name in _PRICES:
        price_missing = price_missing | F.col(name).isNull()
        not_positive = not_positive | (F.col(name) <= 0)
        finer = finer | (F.round(F.col(name), 2) != F.col(name))  # bars are kept in whole cents
    found = [
        F.when(F.col("symbol").isNull() | F.col("trade_date").isNull(), "null_key"),
        F.when(price_missing, "null_price"),
        F.when(F.col("high") < F.col("low"), "high_below_low"),
        F.when(_outside(F.col("open")), "open_out_of_range"),
        F.when(_outside(F.col("close")), "close_out_of_range"),
        F.when(F.col("volume") < 0, "negative_volume"),
        F.when(F.col("volume").isNull(), "null_volume"),
        F.when(not_positive, "non_positive_price"),
        F.when(finer, "sub_cent"),
    ]
    reasons = F.when(F.col("_bad").isNotNull(), F.array(F.lit("unparsable"))).otherwise(
        F.array_compact(F.array(*found))
    )
    if "header_ok" in columns:
        reasons = F.when(~F.col("header_ok"), F.array(F.lit("bad_header"))).otherwise(reasons)
    if "status" in columns:
        reasons = F.when(F.col("status") >= 400, F.array(F.lit("http_status"))).otherwise(reasons)
    return reasons


def classify(
    raw: DataFrame, order: list[str], fetch: list[str] | None = None, salts: int = SALTS
) -> DataFrame:
    """Raw price rows with ``reasons``, why each is rejected; empty if it is accepted.

    ``raw`` has ``symbol``, the price CSV columns and optionally ``header_ok`` and ``status``,
    that of the response (400 and above is an error; null is none known).
    Of the sound rows sharing a (symbol, trade_date) the first by ``order``, then
    by the other columns, is accepted; the others get ``duplicate_key``. ``fetch`` names the columns that
    tell fetches apart: the same key in two fetches is a restatement, no duplicate.
    Every row read is in the result.

    No step gathers a hot key, source or group of copies in one task. The rows of
    a key are first ranked in ``salts`` slices, and only the first of each slice
    meets the others. The slice comes from the row's content and its input
    partition: recomputing a lost task gives the same slices, and equal rows from
    different partitions part. Unsound rows are not ranked, only spread. Which
    rows are accepted does not depend on the slices.
    """
    columns = raw.columns
    key = [*(fetch or []), *KEY]
    ranking = [F.asc_nulls_last(name) for name in [*order, *[c for c in columns if c not in order]]]
    sound = F.size("reasons") == 0
    spread = F.xxhash64(*columns, F.spark_partition_id())

    placed = raw.withColumn("reasons", _row_reasons(columns)).withColumn("_spread", spread)
    placed = placed.withColumn(
        "_slice", F.when(sound, F.pmod("_spread", F.lit(salts))).otherwise(F.col("_spread"))
    ).drop("_spread")
    in_slice = Window.partitionBy(*key, "_slice").orderBy(*ranking)
    first_of_slice = sound & (F.row_number().over(in_slice) == 1)
    # The firsts of a key's slices share the null group; the rest stay spread.
    finalists = placed.withColumn("_finalist", first_of_slice).withColumn(
        "_group", F.when(~F.col("_finalist"), F.col("_slice"))
    )
    in_key = Window.partitionBy(*key, "_finalist", "_group").orderBy(*ranking)
    kept = F.col("_finalist") & (F.row_number().over(in_key) == 1)
    duplicate = F.array(F.lit("duplicate_key"))
    return finalists.withColumn(
        "reasons", F.when(sound & ~kept, duplicate).otherwise(F.col("reasons"))
    ).select(*columns, "reasons")


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def validate(
    raw: DataFrame, order: list[str], fetch: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``classify`` as (accepted rows, rejected rows)."""
    checked = classify(raw, order, fetch)
    return accepted(checked), rejected(checked)


def reason_counts(checked: DataFrame) -> DataFrame:
    """Number of rows per reason; a row with several reasons counts under each."""
    labels = F.when(F.size("reasons") == 0, F.array(F.lit("accepted"))).otherwise(F.col("reasons"))
    return (
        checked.select(F.explode(labels).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def to_bars(sound: DataFrame, *keep: str) -> DataFrame:
    """Accepted price rows as bars in cents, with any further columns named."""
    return sound.withColumns({f"{name}_c": to_cents(F.col(name)) for name in _PRICES}).select(
        *BAR_COLUMNS, *keep
    )


def run_log(runs: DataFrame, checked: DataFrame) -> DataFrame:
    """One row per run: status, reason and row counts.

    ``runs`` lists (run_id, run_date), one row or several per run; ``checked``
    is classified rows carrying ``run_id``. A run that delivered rows but no
    acceptable one has failed, even when the download itself succeeded; one that
    delivered none is empty, as on a holiday.
    """
    delivered = checked.select(
        "run_id",
        F.lit(None).cast("date").alias("run_date"),
        F.lit(1).alias("read"),
        (F.size("reasons") == 0).cast("int").alias("good"),
    )
    started = runs.select("run_id", "run_date", F.lit(0).alias("read"), F.lit(0).alias("good"))
    status = (
        F.when(F.col("rows_in") == 0, "empty").when(F.col("rows_ok") > 0, "ok").otherwise("failed")
    )
    reason = (
        F.when(F.col("rows_in") == 0, "no rows delivered")
        .when(F.col("rows_ok") == 0, "no acceptable row")
        .when(F.col("rows_rejected") > 0, "some rows rejected")
        .otherwise("")
    )
    return (
        started.unionByName(delivered)
        .groupBy("run_id")
        .agg(
            F.max("run_date").alias("run_date"),
            F.sum("read").alias("rows_in"),
            F.sum("good").alias("rows_ok"),
        )
        .withColumn("rows_rejected", F.col("rows_in") - F.col("rows_ok"))
        .select(
            "run_id", "run_date", status.alias("status"), reason.alias("reason"),
            "rows_in", "rows_ok", "rows_rejected",
        )
    )
