"""Revisit resolution and web archives.

``resolve`` decides from headers alone (id, digest, payload size) which record
of equal payloads is the response; ``write`` writes the archives, payloads of
responses only, and ``read`` parses them, ties every revisit to its original
response and gives the payload facts of both.

Headers are shuffled, not payloads: the largest id of each digest is a partial
aggregate, so a payload that a third of all pages share is one row of each
task. Only the write moves payloads, by page id.

An archive is a sequence of WARC/1.1 records in one gzip stream, cut by the
record's Content-Length, so payloads may hold anything, record heads included.
It is written by Spark's text writer: a record ends with two line ends, the
second of which is the writer's line separator.

Defined cases: a null payload is empty; a null id is written without an id and
never a response where another row of its payload has an id; rows with the same
id and payload are written alike, those with the same id and other payloads
have records of their own; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm.common import settle

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Digits of base 32 as Spark's conv() writes them, and RFC 4648's.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 5 hex digits are 4 base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def record_id(page_id: Column, payload_digest: Column) -> Column:
    """Id of a page's record; rows of one page id may differ in their payload."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), payload_digest))
    return F.concat(F.lit("urn:uuid:"), *[
        x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]])


def headers(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        base32_sha1(html).alias("payload_digest"))


def resolve(heads: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``heads`` with refers_to: the response's page_id, null for responses."""
    groups = (heads.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
              .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1"))
    return heads.join(groups, "payload_digest", "left").select(
        "page_id", "payload_bytes", "payload_digest",
        F.when((F.col("payload_bytes") >= min_bytes) & ~F.col("response_id").eqNullSafe(F.col("page_id")),
               F.col("response_id")).alias("refers_to"))


def _line(name: str, value: Column) -> Column:
    """A head line; nothing where the value is null."""
    clean = F.regexp_replace(value, "[\\r\\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write(pages: DataFrame, path: str, *, min_bytes: int = 0, date: str | None = None) -> None:
    """Write the deduplicated archives of ``pages`` (page_id, url, html)."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    decided = (resolve(headers(pages), min_bytes=min_bytes)
               .filter("refers_to IS NOT NULL").select("page_id", "payload_digest", "refers_to").distinct())
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), base32_sha1(html).alias("payload_digest"))
    rows = rows.alias("r").join(
        decided.alias("d"), F.col("r.page_id").eqNullSafe(F.col("d.page_id"))
        & (F.col("r.payload_digest") == F.col("d.payload_digest")), "left").select("r.*", "d.refers_to")
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("html")
    http = F.concat(F.lit(HTTP_HEAD), F.lit("Content-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(size)
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<"), record_id(F.col("page_id"), F.col("payload_digest")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), record_id(F.col("refers_to"), F.col("payload_digest")), F.lit(">")))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit("\r\n"), block, F.lit("\r\n"))
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Heads (names in lower case) and blocks of one uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"cut record at byte {at}")
        yield head, data[start:stop]
        at = stop + 4


FACTS = "page_id long, record_type string, record string, refers string, payload_bytes long, payload_digest string"


def _facts(head: dict[str, str], block: bytes) -> tuple:
    """A record's own facts; of a revisit, the payload's size is its original's."""
    revisit = head["warc-type"] == "revisit"
    payload = block[block.find(b"\r\n\r\n") + 4:]
    digest = head["warc-payload-digest"].removeprefix("sha1:") if revisit else \
        base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if not revisit and digest != head["warc-payload-digest"].removeprefix("sha1:"):
        raise ValueError(f"payload of {head['warc-record-id']} doesn't match its digest")
    page = head.get("x-page-id")
    return (int(page) if page else None, head["warc-type"], head["warc-record-id"],
            head.get("warc-refers-to"), None if revisit else len(payload), digest)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""

    def parse(batches):
        for batch in batches:
            for data in batch.column(0):
                plain = zlib.decompress(data.as_buffer(), wbits=47)
                found = [_facts(head, block) for head, block in records(plain)]
                if found:
                    cols = list(zip(*found, strict=True))
                    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                        names=[f.split()[0] for f in FACTS.split(", ")])

    found = settle(spark.read.format("binaryFile").load(path).select("content")
                   .filter("length(content) > 0").mapInArrow(parse, FACTS), "warc-heads")
    originals = (found.filter("record_type = 'response'").groupBy(F.col("record").alias("original"))
                 .agg(F.max("page_id").alias("original_id"), F.max("payload_bytes").alias("original_bytes")))
    return (found.join(originals, F.col("refers") == F.col("original"), "left")
            .select("page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
                    "payload_digest", "record_type", F.col("original_id").alias("refers_to")))


def oracle() -> str:
    """The read-back facts, straight from ``pages``."""
    digits = "list_transform(range(0, 8), lambda i: ('0x' || substr(h, 5 * i::INT + 1, 5))::BIGINT)"
    base32 = (f"list_aggregate(flatten(list_transform({digits}, lambda v: list_transform([15, 10, 5, 0], lambda s: "
              f"substr('{BASE32_DIGITS}', ((v >> s) & 31)::INT + 1, 1)))), 'string_agg', '')")
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
        d AS (SELECT page_id, payload_bytes, {base32} AS payload_digest FROM h),
        g AS (SELECT payload_digest, max(page_id) AS best FROM d GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
        FROM d JOIN g USING (payload_digest)"""
