"""WARC archives: records written by Spark, read back, and joined into captures.

A capture is three records: the request, the response (or, for a payload that
another capture holds, a revisit of it) and metadata. Request and metadata name the
response in WARC-Concurrent-To; reading joins them through that header.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import frames
from barloom.sources.scratch import materialize

#: Bytes of records in a file, about; a file is read whole by one task.
FILE_BYTES = 16_000_000

#: Copies of a repeated page written by one task; before they are dealt to tasks, the page is held once a bundle.
BUNDLE = 256

END = "\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are 20 bits, so 4 letters."""
    digest = F.sha1(data)
    letters = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(ALPHABET), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1))
            for shift in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def _code(kind: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _urn(kind: str, *parts: Column) -> Column:
    """A record id that is the same each time the record is written."""
    code = _code(kind, *parts)
    dashed = F.concat_ws("-", *[F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """The record without the two line ends that close it, which the writer adds."""
    lines = [F.lit("WARC/1.1" + END)]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit("")))
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END), block]
    return F.concat(*lines)


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", files: int | None = None
) -> DataFrame:
    """(record) of three records a row, dealt over ``files`` partitions; equal payloads are written once, by the largest page id.

    The others are revisits of that one. Null html is an empty payload, a null url has
    no target line. Rows that repeat page id, url and payload are captures of their own,
    told apart by a number in their ids; they are responses if they hold the largest
    page id, and revisits name number 0. Rows with a null id are responses that no one
    revisits. Other columns are not looked at; no rows give no records.

    Payloads never move by their digest: ids and digests are counted first, with
    map-side sums, and written; the payload is joined by page. Repeated rows are met
    with map-side counts, one payload each, then dealt in bundles of their numbers.
    """
    body = F.coalesce(frames.col(html), F.lit(""))
    source = pages.select(
        frames.col(page_id).cast("bigint").alias("page_id"), frames.col(url).alias("url"), body.alias("body")
    ).withColumn("digest", base32_sha1(F.col("body").cast("binary")))
    # The url last, as it alone may hold line ends; a null one differs from an empty one.
    source = source.withColumn("key", _code("page", F.col("page_id"), F.col("digest"), F.concat(F.lit("="), F.col("url"))))
    keys = materialize(source.groupBy("key", "page_id", "digest").agg(F.count("*").alias("n")), "keys")
    light = materialize(  # so that the join by digest can split a payload with very many pages
        keys.where("page_id is not null").groupBy("digest")
        .agg(F.max(F.struct("page_id", "key")).alias("top"), F.min("page_id").alias("least"))
        .where("least < top.page_id").select("digest", F.col("top.page_id").alias("top"), F.col("top.key").alias("first")),
        "firsts",
    )
    copies = keys.join(light, "digest").where("page_id < top").select("key", "first")
    repeats = keys.where("n > 1").select("key")
    repeated = not repeats.isEmpty()
    once = source.join(repeats, "key", "left_anti") if repeated else source
    if files:
        once = once.repartition(files, "key")
    whole = once.join(copies, "key", "left").withColumn("number", F.lit(0).cast("bigint"))
    if repeated:
        columns = ["page_id", "url", "body", "digest"]
        many = source.groupBy("key").agg(*[F.first(c).alias(c) for c in columns], F.count("*").alias("n")).where("n > 1")
        bundles = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / BUNDLE))
        many = many.join(copies, "key", "left").withColumn("bundle", F.explode(bundles))
        many = many.repartition(*[files] * bool(files), "key", "bundle")
        last = F.least(F.col("bundle") * BUNDLE + BUNDLE, F.col("n")) - 1
        many = many.select("key", *columns, "first", F.explode(F.sequence(F.col("bundle") * BUNDLE, last)).alias("number"))
        whole = whole.unionByName(many)
    own = _urn("response", F.col("key"), F.col("number"))
    refers = F.when(F.col("first").isNotNull(), _urn("response", F.col("first"), F.lit(0)))
    at = [("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", "")), ("WARC-Date", F.lit("2024-01-01T00:00:00Z"))]
    payload = F.when(F.col("first").isNull(), F.col("body")).otherwise(F.lit(""))
    status = F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END + END)
    response = _record(
        [
            ("WARC-Type", F.when(F.col("first").isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
            ("WARC-Record-ID", own),
            *at,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Refers-To", refers),
            ("WARC-Profile", F.when(refers.isNotNull(), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(status, payload),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _urn("request", F.col("key"), F.col("number"))),
            *at,
            ("WARC-Concurrent-To", own),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce(F.regexp_replace("url", "\\s", ""), F.lit("/")), F.lit(" HTTP/1.1" + END + END)),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _urn("metadata", F.col("key"), F.col("number"))),
            *at,
            ("WARC-Concurrent-To", own),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(
            F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END),
            F.lit("payloadLength: "), F.octet_length("body").cast("string"), F.lit(END),
        ),
    )
    return whole.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    file_bytes: int = FILE_BYTES,
) -> None:
    """The pages' records as gzipped WARC files of about ``file_bytes`` before compression (more for a single larger page)."""
    total = pages.agg(F.sum(F.coalesce(F.octet_length(frames.col(html)), F.lit(0)) + 2_000)).first()[0] or 0
    held = records(pages, page_id, url, html, max(1, -(-total // file_bytes)))
    held.write.option("lineSep", END + END).option("compression", "gzip").text(path)


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record, by Content-Length; what a block contains cannot mislead."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts here: {line[:80]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: type, id, concurrent_to, refers_to, url, digest, block (the HTTP head and payload apart)."""

    def start():
        def work(contents):
            for content in contents:
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))
                for headers, block in parse(stream):
                    http = headers.get("content-type", "").startswith("application/http")
                    head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
                    yield (
                        headers.get("warc-type"), headers.get("warc-record-id"), headers.get("warc-concurrent-to"),
                        headers.get("warc-refers-to"), headers.get("warc-target-uri"),
                        headers.get("warc-payload-digest", "").removeprefix("sha1:"),
                        head.decode("utf-8", "replace"), payload, len(payload),
                        base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    )

        return work

    fields = {
        "type": "string", "id": "string", "concurrent_to": "string", "refers_to": "string", "url": "string",
        "stated_digest": "string", "head": "string", "payload": "binary", "n_bytes": "bigint", "digest": "string",
    }
    files = spark.read.format("binaryFile").load(path).where(F.col("path").endswith(".gz"))
    return frames.explode_rows(files, [F.col("content")], start, fields)


def assemble(held: DataFrame, payload: bool = True) -> DataFrame:
    """One nested row a capture: (capture, request, response, metadata), joined through concurrent-to.

    Requests and metadata that name no existing response, and responses without them,
    stay as captures with nulls. Records are met by id in one aggregate, so a capture
    is a group of three rows; of repeated equal records one is kept. Without
    ``payload``, responses have their payload's length and digest only.
    """
    key = F.coalesce("concurrent_to", "id")

    def one(kind: Column, columns: list[str]) -> Column:
        return F.max(F.when(kind, F.struct(*columns)))

    return held.groupBy(key.alias("capture")).agg(
        one(F.col("type") == "request", ["id", "url", "head"]).alias("request"),
        one(
            F.col("type").isin("response", "revisit"),
            ["id", "type", "url", "head", "refers_to", "stated_digest", "digest", "n_bytes"]
            + ["payload"] * payload,
        ).alias("response"),
        one(F.col("type") == "metadata", ["id", "payload"]).alias("metadata"),
    )


def metadata_field(name: str) -> Column:
    text = F.decode(F.col("metadata.payload"), "UTF-8")
    return F.regexp_extract(text, f"(?m)^{name}: ?([^\r\n]*)", 1)


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (a page id)."""
    whole = assemble(read(spark, path), payload=False).select(
        F.when(metadata_field("pageId") != "", metadata_field("pageId").cast("bigint")).alias("page_id"),
        F.col("response.id").alias("id"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers"),
        F.col("response.digest").alias("digest"),
        F.col("response.n_bytes").alias("n_bytes"),
    )
    whole = materialize(whole, "captures")
    targets = whole.where("record_type = 'response'").select(
        F.col("id").alias("refers"), F.col("page_id").alias("target"),
        F.col("digest").alias("target_digest"), F.col("n_bytes").alias("target_bytes"),
    )
    result = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = whole.where("record_type = 'revisit'").join(targets.dropDuplicates(["refers"]), "refers", "left")
    revisits = revisits.select(
        "page_id", F.col("target_bytes").alias("payload_bytes"), F.col("target_digest").alias("payload_digest"),
        "record_type", F.col("target").alias("refers_to"),
    )
    own = whole.where("record_type is null or record_type <> 'revisit'").select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.lit(None).cast("bigint").alias("refers_to"),
    )
    return own.unionByName(revisits).select(*result)
