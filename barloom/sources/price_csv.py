"""Price CSV: files landed as ``fetch_date=.../symbol=.../*.csv``, and fetched bodies."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import CSV_DDL, CSV_HEADER, CSV_SCHEMA
from barloom.sources.scratch import materialize

_PARTITIONS = [
    T.StructField("fetch_date", T.DateType()),
    T.StructField("symbol", T.StringType()),
]
FILE_SCHEMA = T.StructType([*CSV_SCHEMA.fields, *_PARTITIONS])

# The header line is read as a row, since Spark binds columns by position and,
# told to skip a header, would skip the first price of a file that has none.
READ_OPTIONS = {"header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}


#: The header line of the files, or several that are all taken (other names of the date column, say).
Header = str | tuple[str, ...]


#: The columns a price file names in its header, in the order they are kept in.
NAMES = CSV_HEADER.split(",")
#: Other names that a header may use, as they stand after trimming and in lower case.
ALIASES = {"date": "trade_date", "day": "trade_date", "timestamp": "trade_date", "vol": "volume"}


def _is_header(line: Column, header: Header) -> Column:
    lines = [one.strip().lower() for one in ([header] if isinstance(header, str) else header)]
    known = ["open", "high", "low", "close", "volume"]
    for one in lines:
        prices = [name.strip() for name in one.split(",")][1:]
        if sorted(prices) == sorted(known) and prices != known:
            raise ValueError(f"columns are read by position, as date, {', '.join(known)}; the header has {one}")
    return F.coalesce(F.lower(F.trim(line)).isin(*lines), F.lit(False))


def scan(files: DataFrame, header: Header = CSV_HEADER) -> DataFrame:
    """A CSV read (batch or streaming) with the file of each row and ``is_header``."""
    return files.withColumn("source_file", F.col("_metadata.file_path")).withColumn(
        "is_header", F.col("trade_date").isNull() & _is_header(F.col("_bad"), header)
    )


def without_headers(scanned: DataFrame) -> DataFrame:
    """The price rows of a scan.

    Spark parses only the columns a query uses, and a row is then bad or not
    depending on the query. Using every column here makes it the same for all.
    """
    header_line = F.col("is_header")
    for field in CSV_SCHEMA:
        if field.name != "_bad":
            header_line = header_line & F.col(field.name).isNull()
    return scanned.where(~header_line).drop("is_header")


def files_without_header(scanned: DataFrame) -> DataFrame:
    """Files of a scan in which the expected header line does not occur.

    Parses the first column only; one flag per file is shuffled.
    """
    return (
        scanned.groupBy("source_file")
        .agg(F.max("is_header").alias("has_header"))
        .where(~F.col("has_header"))
        .select("source_file")
    )


def check_headers(scanned: DataFrame) -> DataFrame:
    """The price rows of a scan with ``header_ok``, false if their file lacks the header.

    The faulty files are found and written first, so the rows need no join when
    there are none. When there are, Spark knows the size of the written list: it
    broadcasts a small one and leaves the rows where they are; for a long one its
    sorted join splits a file that dominates.
    """
    faulty = materialize(
        files_without_header(scanned).withColumn("faulty", F.lit(True)), "faulty_files"
    )
    rows = without_headers(scanned)
    if faulty.isEmpty():
        return rows.withColumn("header_ok", F.lit(True))
    return (
        rows.join(faulty, "source_file", "left")
        .withColumn("header_ok", F.col("faulty").isNull())
        .drop("faulty")
    )


def _scan_path(spark: SparkSession, path: str, header: Header) -> DataFrame:
    return scan(spark.read.schema(FILE_SCHEMA).options(**READ_OPTIONS).csv(path), header)


def read_prices(spark: SparkSession, path: str, header: Header = CSV_HEADER) -> DataFrame:
    """Raw price rows of all files below ``path``; unparsable lines are kept in ``_bad``."""
    return without_headers(_scan_path(spark, path, header))


def read_checked(spark: SparkSession, path: str, header: Header = CSV_HEADER) -> DataFrame:
    """``read_prices`` with ``header_ok`` for each row; reads the files once to find it."""
    return check_headers(_scan_path(spark, path, header))


def read_flat(
    spark: SparkSession, path: str, symbol: str, fetch_date: datetime.date, header: Header = CSV_HEADER
) -> DataFrame:
    """``read_checked`` for files of one symbol and fetch whose path names neither."""
    files = spark.read.schema(CSV_SCHEMA).options(**READ_OPTIONS).csv(path)
    return check_headers(scan(files, header)).withColumns(
        {"fetch_date": F.lit(fetch_date), "symbol": F.lit(symbol)}
    )


def stream_scan(
    spark: SparkSession, path: str, max_files: int | None = None, header: Header = CSV_HEADER
) -> DataFrame:
    """Files as they arrive, scanned; each batch then goes through ``check_headers``."""
    reader = spark.readStream.schema(FILE_SCHEMA).options(**READ_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return scan(reader.csv(path), header)


#: A comma outside quotes: one with an even number of quotes after it.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _fields(line: Column) -> Column:
    """The fields of a CSV line, quotes and all."""
    return F.when(line.contains('"'), F.split(line, _COMMA, -1)).otherwise(F.split(line, ",", -1))


def _places(line: Column, aliases: dict[str, str]) -> Column:
    """Where a header line has each of ``NAMES``, from 1, and its number of columns; null for a line that is no header.

    A line that names a column twice is no header.
    """
    plain = F.transform(_fields(line), lambda field: F.lower(F.btrim(field, F.lit(" \t\r\""))))
    known = F.create_map(*[F.lit(word) for pair in aliases.items() for word in pair]) if aliases else None
    named = plain if known is None else F.transform(plain, lambda field: F.coalesce(F.element_at(known, field), field))
    once = F.size(F.array_distinct(named)) == F.size(named)
    every = F.size(F.array_except(F.array(*map(F.lit, NAMES)), named)) == 0
    places = F.array(*[F.array_position(named, name).cast("int") for name in NAMES], F.size(named))
    return F.when(once & every, places)


def _as_kept(line: Column, places: Column) -> Column:
    """A line with the columns in the order of ``NAMES`` alone; null if it has another number of columns than its header."""
    fields = _fields(line)
    picked = F.transform(F.slice(places, 1, len(NAMES)), lambda place: F.element_at(fields, place))
    return F.when(F.size(fields) == F.element_at(places, -1), F.array_join(picked, ","))


def _plain() -> Column:
    """Places for a file without a header: as kept, so that its rows can be shown beside the reason they are rejected."""
    return F.array(*[F.lit(i) for i in [*range(1, len(NAMES) + 1), len(NAMES)]])


def _parsed(lines: DataFrame, line: str, places: str) -> DataFrame:
    """``lines`` with the price columns in place of ``line`` and ``places``, parsed as by position."""
    others = [name for name in lines.columns if name not in (line, places)]
    picked = lines.withColumn("_line", _as_kept(F.col(line), F.col(places)))
    options = {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}
    row = F.from_csv(F.coalesce(F.col("_line"), F.lit("")), CSV_DDL, options)
    raw = F.when(F.col("_line").isNull() | F.col("_row._bad").isNotNull(), F.col(line))
    return picked.withColumn("_row", row).select(
        *others, *[F.col(f"_row.{name}").alias(name) for name in NAMES], raw.alias("_bad")
    )


_LINES = T.StructType([T.StructField("line", T.StringType()), *_PARTITIONS])


def check_named(scanned: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Lines of files as price rows, each file's columns found by the names in its header line.

    ``scanned`` has ``line`` and ``source_file``. Columns may stand in any order, and files may have
    others besides. ``header_ok`` is false for the rows of a file that has no header, or several
    that differ. A line with another number of columns than its header is unparsable.

    One pass finds the headers, a row per file; then all files are read in one more, whatever
    the orders. If all have the same order, no row is joined to its file's.
    """
    found = scanned.withColumn("places", _places(F.col("line"), aliases)).select("source_file", "places")
    headers = found.groupBy("source_file").agg(F.min("places").alias("places"), F.max("places").alias("other"))
    one = F.col("places").isNotNull() & (F.col("places") == F.col("other"))
    headers = materialize(headers.select("source_file", F.when(one, F.col("places")).alias("places")), "headers")
    orders = headers.select("places").distinct().limit(2).collect()

    rows = scanned.where((F.trim("line") != "") & _places(F.col("line"), aliases).isNull())
    if len(orders) == 1 and orders[0]["places"] is not None:
        rows = rows.withColumn("places", F.array(*map(F.lit, orders[0]["places"]))).withColumn("header_ok", F.lit(True))
    else:
        rows = rows.join(headers, "source_file", "left")
        rows = rows.withColumn("header_ok", F.col("places").isNotNull()).withColumn("places", F.coalesce("places", _plain()))
    return _parsed(rows, "line", "places")


def read_named(spark: SparkSession, path: str, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """``read_checked`` for files that have their columns in any order, each its own; reads the files twice."""
    lines = spark.read.schema(_LINES).text(path).withColumn("source_file", F.col("_metadata.file_path"))
    return check_named(lines, aliases)


def stream_named(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of files as they arrive; each batch then goes through ``check_named``."""
    reader = spark.readStream.schema(_LINES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).withColumn("source_file", F.col("_metadata.file_path"))


def parse_named_payloads(payloads: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """``parse_payloads`` for bodies that have their columns in any order, each by its first line."""
    kept = [name for name in payloads.columns if name != "body"]
    split = payloads.select(*kept, F.split(F.coalesce(F.col("body"), F.lit("")), "\r?\n").alias("lines"))
    found = split.withColumn("places", _places(F.col("lines")[0], aliases))
    flagged = found.withColumn("header_ok", F.col("places").isNotNull()).withColumn("places", F.coalesce("places", _plain()))
    lines = flagged.select(*kept, "header_ok", "places", F.posexplode("lines").alias("line_no", "line"))
    wanted = F.when(F.col("line_no") == 0, ~F.col("header_ok")).otherwise(F.trim("line") != "")
    return _parsed(lines.where(wanted), "line", "places")


def write_prices(bars: DataFrame, path: str, columns: dict[str, str] | None = None) -> None:
    """Bars with ``fetch_date`` as price CSV files, one directory per fetch date and symbol.

    ``columns`` gives the header's names in their order, and the column under each; as kept unless given.
    The rebalance hint gathers a symbol's rows into few files and splits a partition that grows too large.
    """
    cent = F.lit("0.01").cast("decimal(2,2)")
    prices = bars.hint("rebalance", "fetch_date", "symbol").select(
        "fetch_date",
        "symbol",
        "trade_date",
        *[
            (F.col(f"{name}_c").cast("decimal(18,0)") * cent).alias(name)
            for name in ["open", "high", "low", "close"]
        ],
        "volume",
    )
    shown = columns or {name: name for name in NAMES}
    named = prices.select("fetch_date", "symbol", *[F.col(name).alias(title) for title, name in shown.items()])
    named.write.partitionBy("fetch_date", "symbol").option("header", "true").mode("append").csv(path)


def parse_payloads(payloads: DataFrame, header: Header = CSV_HEADER) -> DataFrame:
    """Fetched bodies, one per row in ``body``, to raw price rows; other columns are kept.

    Line ends may be LF or CRLF. A body whose first line is not the header (a
    JSON error message, say) yields that line too, so that the body is seen to
    be rejected; all its rows carry ``header_ok`` = false. An empty body counts
    as one such line. No shuffle; what a task holds at a time is one body.
    """
    kept = [name for name in payloads.columns if name != "body"]
    split = payloads.select(
        *kept, F.split(F.coalesce(F.col("body"), F.lit("")), "\r?\n").alias("lines")
    )
    # The flag is made in a step of its own: beside the explode, Spark would carry
    # the whole body along with each of its lines.
    flagged = split.withColumn("header_ok", _is_header(F.col("lines")[0], header))
    lines = flagged.select(*kept, "header_ok", F.posexplode("lines").alias("line_no", "line"))
    wanted = F.when(F.col("line_no") == 0, ~F.col("header_ok")).otherwise(F.trim("line") != "")
    return (
        lines.where(wanted)
        .withColumn(
            "_row",
            F.from_csv(
                "line",
                CSV_DDL,
                {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"},
            ),
        )
        .select(*kept, "header_ok", "line_no", "_row.*")
    )


def to_payloads(lines: DataFrame, *keys: str, header: str = CSV_HEADER) -> DataFrame:
    """Numbered CSV lines ``(*keys, line_no, line)`` to one CRLF body per key.

    A body is one fetch of one symbol, at most a line per day and correction.
    """
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy(*keys).agg(
        F.concat_ws(
            "\r\n", F.lit(header), F.transform(ordered, lambda entry: entry["line"])
        ).alias("body")
    )
