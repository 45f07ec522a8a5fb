"""Exports in one global order (K1, W1): parts of like bytes that, one after
the other, are the whole CSV, with a hash tree over all lines (A3).

Layout under ``<out_dir>/``::

    <name>/bucket=<k>/part-*.txt   lines in order; the header is in bucket 0 only
    _manifest/                     parquet: bucket, file, first, rows, bytes, sha256
    _tree/                         parquet: the hash tree's nodes (``tree_digest``)

The order is that of the key columns, then of the line's MD5; equal lines may
go to any of their places, so a hash of the row's place in the staged table
comes last in the sort key, and a line that a third of all rows hold is split
over as many parts as its bytes need. Lines are rendered once, into a staged
table; its keys and sizes give the parts (``byte_ranges``), then it is dealt
out and sorted within parts.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docferry.functions.render import header_line
from docferry.operators import tree_digest
from docferry.operators.byte_ranges import ENTRIES, byte_splitters, order_key, range_of
from docferry.sources import fs

TARGET_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class OrderedExport:
    path: str
    manifest_path: str
    tree_path: str
    row_count: int
    n_parts: int
    root: str


def records(data: bytes) -> list[bytes]:
    """CSV records of a part; a line break inside quotes belongs to its cell."""
    out: list[bytes] = []
    held: list[bytes] = []
    for line in data.split(b"\n")[:-1]:
        if not held and line.count(b'"') % 2 == 0:
            out.append(line)
            continue
        held.append(line)
        if len(held) > 1 and line.count(b'"') % 2:
            out.append(b"\n".join(held))
            held = []
    if held:
        raise ValueError("a part ends inside quotes")
    return out


def read_parts(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """(bucket, pos, line) of the written parts, each read whole in one task;
    with ``buckets`` of these only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    if buckets is not None:
        files = files.filter(F.col("bucket").isin(buckets))

    def run(batches):
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lines = records(data.as_buffer().to_pybytes())[1 if bucket == 0 else 0:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket] * len(lines), pa.int32()), pa.array(range(len(lines)), pa.int64()),
                     pa.array(lines, pa.binary()).cast(pa.string())], names=["bucket", "pos", "line"])

    return files.select(F.col("bucket").cast("int"), "content").mapInArrow(run, "bucket int, pos bigint, line string")


def numbered_lines(spark: SparkSession, export: OrderedExport, buckets: list[int] | None = None) -> DataFrame:
    """(idx, line): the export's lines, read from its parts, with their
    position in the whole."""
    # One row for each part.
    first = spark.read.parquet(export.manifest_path).select("bucket", "first")
    return read_parts(spark, export.path, buckets).join(F.broadcast(first), "bucket").select(
        (F.col("first") + F.col("pos")).alias("idx"), "line")


def write_ordered(rows: DataFrame, keys: list[str], columns: list[str], *, out_dir: str, name: str = "export.csv",
                  target_bytes: int = TARGET_BYTES, entries: int = ENTRIES) -> OrderedExport:
    """Export ``rows`` (the key columns and ``line``) in key order."""
    spark = rows.sparkSession
    staged_dir, path = f"{out_dir}/_staged", f"{out_dir}/{name}"
    rows.select(order_key(rows, keys).alias("key"), "line").write.mode("overwrite").parquet(staged_dir)
    place = F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0")
    staged = spark.read.parquet(staged_dir).select(
        F.concat_ws(" ", "key", F.md5(F.col("line").cast("binary")), place).alias("key"), "line")
    sizes = byte_splitters(staged.select("key", (F.octet_length("line") + 1).alias("size")), target_bytes,
                           entries=entries)
    n_parts = len(sizes.splitters) + 1
    dealt = staged.select(range_of(F.col("key"), sizes.splitters, staged).alias("bucket"), "key", "line")
    head = spark.range(1).select(F.lit(0).alias("bucket"), F.lit("").alias("key"),
                                 F.lit(header_line(columns)).alias("line"))
    (dealt.unionByName(head).repartitionById(n_parts, F.col("bucket")).sortWithinPartitions("bucket", "key")
     .select("bucket", "line").write.mode("overwrite").partitionBy("bucket").option("lineSep", "\n").text(path))
    fs.delete(spark, staged_dir)
    return describe(spark, out_dir, name, n_parts)


def describe(spark: SparkSession, out_dir: str, name: str, n_parts: int) -> OrderedExport:
    """Read the written parts back: manifest and hash tree."""
    path, manifest, tree = f"{out_dir}/{name}", f"{out_dir}/_manifest", f"{out_dir}/_tree"
    counts = read_parts(spark, path).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select(
        F.col("bucket").cast("int").alias("bucket"), F.substring_index("path", "/", -2).alias("file"),
        F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    # One row for each part.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    (files.join(counts, "bucket", "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("bigint"))
     .withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("bigint"))
     .select("bucket", "file", "first", "rows", "bytes", "sha256").write.mode("overwrite").parquet(manifest))
    total = spark.read.parquet(manifest).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    export = OrderedExport(path, manifest, tree, int(total), n_parts, "")
    nodes = tree_digest.build(numbered_lines(spark, export), tree)
    return OrderedExport(path, manifest, tree, int(total), n_parts, tree_digest.root(nodes))


def buckets_of(spark: SparkSession, export: OrderedExport, chunks: DataFrame) -> list[int]:
    """Parts that hold lines of the chunks (one row for each part read)."""
    parts = spark.read.parquet(export.manifest_path)
    wanted = chunks.select((F.col("idx") * tree_digest.CHUNK).alias("low"))
    cross = parts.select("bucket", F.explode(F.sequence(
        F.shiftright("first", tree_digest.STEP), F.shiftright(F.greatest(F.col("first") + F.col("rows") - 1, F.col("first")),
                                                             tree_digest.STEP))).alias("chunk"))
    return sorted(r.bucket for r in cross.join(
        wanted, F.col("chunk") * tree_digest.CHUNK == F.col("low"), "left_semi").select("bucket").distinct().collect())
