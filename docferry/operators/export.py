"""CSV export of projected rows: parts, per-part digests, manifest, publish.

Layout of one export under ``<root>/<job_id>/`` (``name`` is the base name
of the job's remote file)::

    <name>/bucket=<k>/part-*.txt   one CSV per bucket, header first, rows sorted
    <name>.sha256                  "<hex>  <name>/bucket=<k>/part-...txt" per part
    _manifest/                     parquet: bucket, file, rows, bytes, sha256

so ``sha256sum -c <name>.sha256`` checks every part from the folder above.

Scale decisions:

* Rows go to ``n_parts`` buckets by a hash of the document id (or of the line
  where there is none); ``n_parts`` comes from the rows and bytes of the lines
  that the job selects (see ``plans.job_run``).
* One shuffle (the repartition by bucket) and a sort within each task; every
  bucket is written by exactly one task, so it is exactly one file.
* SHA-256 does not combine across parts, so there is one digest per part,
  computed in parallel from the written bytes (``binaryFile``); the sidecar
  lists them in ``sha256sum -c`` format. Manifest and sidecar are written by
  Spark; the driver receives only the sidecar's digest and the row total.
* Written rows are counted while writing (``observe``), independently of the
  source count used by reconciliation.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docferry.functions.render import header_line
from docferry.sources import fs

DEFAULT_ROWS_PER_PART = 1_000_000


def part_count(expected_rows: int, rows_per_part: int = DEFAULT_ROWS_PER_PART) -> int:
    if rows_per_part <= 0:
        raise ValueError("rows_per_part must be positive")
    return max(1, math.ceil(expected_rows / rows_per_part))


def bucket_of(key: Column, n_parts: int) -> Column:
    """Deterministic bucket in [0, n_parts) from a key (hash-spread)."""
    return F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("int")


# The Park-Miller multiplier and modulus (a prime), used to
# spread integer keys before ``mod n`` so that patterned keys (every 32nd
# value, say) do not pile into a few buckets.
_PM_MULT = 16807
_PM_MOD = 2147483647


def int_bucket(key: Column, n_parts: int) -> Column:
    """Deterministic bucket of an integer key, reproducible in plain SQL."""
    mixed = F.pmod(F.pmod(key.cast("bigint"), F.lit(_PM_MOD)) * F.lit(_PM_MULT), F.lit(_PM_MOD))
    return F.pmod(mixed, F.lit(n_parts)).cast("int")


def bucket_digests(lines: DataFrame, header: str) -> DataFrame:
    """(bucket, rows, sha256) of each part's text, computed from the rows.

    A part's text is the header, then the part's lines in byte order, each
    ending in ``\\n``. Each bucket is one group, bounded by ``rows_per_part``.
    """
    return (lines.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sha2(F.concat(F.lit(header + "\n"),
                                 F.array_join(F.array_sort(F.collect_list("line")), "\n"),
                                 F.lit("\n")), 256).alias("sha256")))


@dataclass(frozen=True)
class ExportResult:
    job_id: str
    path: str
    sidecar_path: str
    manifest_path: str
    row_count: int
    n_parts: int
    sha256: str  # digest of the sidecar text: one value naming every part


def write_parts(lines: DataFrame, header: str, data_dir: str, n_parts: int) -> int:
    """Write ``(bucket, line)`` rows as one CSV text file per bucket.

    Returns the number of data rows written (observed during the write).
    """
    spark = lines.sparkSession
    rows = lines.select(F.col("bucket").cast("int").alias("bucket"),
                        F.lit(1).alias("ord"), F.col("line"))
    heads = spark.range(n_parts).select(F.col("id").cast("int").alias("bucket"),
                                        F.lit(0).alias("ord"), F.lit(header).alias("line"))
    obs = Observation("written")
    out = (rows.unionByName(heads)
           .repartitionById(n_parts, F.col("bucket"))
           .sortWithinPartitions("bucket", "ord", "line")
           .observe(obs, F.sum(F.col("ord")).alias("rows")))
    (out.select("bucket", "line").write.mode("overwrite")
        .partitionBy("bucket").option("lineSep", "\n").text(data_dir))
    return int(obs.get["rows"] or 0)


def read_back_manifest(spark: SparkSession, data_dir: str) -> DataFrame:
    """(bucket, file, rows, bytes, sha256) of the written parts (R5 input)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt")
             .load(data_dir)
             .select("bucket", F.substring_index("path", "/", -2).alias("file"),
                     F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")))
    # Records, not lines: a quoted cell may hold line breaks. Each part is
    # parsed whole (multiLine), one task per part.
    counts = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"').option("mode", "FAILFAST").csv(data_dir)
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")))
    return files.join(counts, "bucket", "left").select(
        F.col("bucket").cast("int").alias("bucket"),
        F.concat(F.lit("bucket="), F.col("bucket").cast("string"), F.lit("/"),
                 F.substring_index("file", "/", -1)).alias("file"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "bytes", "sha256")


def export_lines(lines: DataFrame, columns: list[str], *, job_id: str, out_dir: str,
                 n_parts: int, name: str = "export.csv") -> ExportResult:
    """Write the export of ``lines`` (columns ``bucket``, ``line``) and its
    manifest and sidecar under ``out_dir``; the sidecar is written last."""
    header = header_line(columns)
    written = write_parts(lines, header, f"{out_dir}/{name}", n_parts)
    res = manifest_and_sidecar(lines.sparkSession, job_id=job_id, out_dir=out_dir, name=name,
                               n_parts=n_parts)
    return ExportResult(res.job_id, res.path, res.sidecar_path, res.manifest_path,
                        written, res.n_parts, res.sha256)


def manifest_and_sidecar(spark: SparkSession, *, job_id: str, out_dir: str, name: str,
                         n_parts: int) -> ExportResult:
    """Read the written parts back (digest and record count per part), keep
    the manifest, then write the sidecar. ``row_count`` is the manifest's."""
    data_dir = f"{out_dir}/{name}"
    manifest_dir = f"{out_dir}/_manifest"
    # The shuffle keeps the digests parallel; only the manifest is one task.
    read_back_manifest(spark, data_dir).repartition(1).write.mode("overwrite").parquet(manifest_dir)
    manifest = spark.read.parquet(manifest_dir)
    sums = manifest.orderBy("bucket").select(
        F.concat("sha256", F.lit("  " + name + "/"), "file").alias("line"))
    sidecar = f"{out_dir}/{name}.sha256"
    tmp = f"{out_dir}/_sidecar_tmp"
    sums.coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(tmp)
    fs.single_file(spark, tmp, sidecar, "part-*.txt")
    # Digest of the sidecar text and the row total, from the manifest (one
    # row per part) in one aggregate.
    summary = manifest.agg(
        F.sha2(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("bucket", F.concat(
                "sha256", F.lit("  " + name + "/"), "file", F.lit("\n")).alias("l")))),
            lambda x: x["l"]), ""), 256).alias("sha256"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    return ExportResult(job_id=job_id, path=data_dir, sidecar_path=sidecar,
                        manifest_path=manifest_dir, row_count=int(summary["rows"]), n_parts=n_parts,
                        sha256=summary["sha256"])


def write_parts_multi(lines: DataFrame, headers: dict[str, str], parts: dict[str, int],
                      root: str) -> None:
    """Write ``(job_id, bucket, line)`` rows of several jobs in one pass:
    ``root/job_id=<id>/bucket=<k>/`` holds one CSV file per job and bucket,
    each starting with that job's header."""
    spark = lines.sparkSession
    # One row for each job; its header rows are made on the executors.
    first, table = 0, []
    for j, n in parts.items():
        table.append((j, n, first, headers[j]))
        first += n
    jobs = spark.createDataFrame(table, "job_id string, n int, first int, line string")
    heads = jobs.select("job_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bucket"),
                        F.lit(0).alias("ord"), "line")
    rows = lines.select("job_id", F.col("bucket").cast("int").alias("bucket"),
                        F.lit(1).alias("ord"), "line")
    place = jobs.select("job_id", "first")
    out = (rows.unionByName(heads).join(F.broadcast(place), "job_id")
           .repartitionById(first, (F.col("first") + F.col("bucket")).cast("int"))
           .sortWithinPartitions("job_id", "bucket", "ord", "line")
           .select("job_id", "bucket", "line"))
    (out.write.mode("overwrite").partitionBy("job_id", "bucket")
        .option("lineSep", "\n").text(root))


def publish(spark: SparkSession, result: ExportResult, target: str) -> ExportResult:
    """Move the parts to ``target`` and then the sidecar to
    ``target + ".sha256"``; a present sidecar means a complete export.

    Only an earlier export (a folder with its sidecar beside it) is replaced:
    it is moved aside first and deleted when the new one is in place."""
    side = target + ".sha256"
    earlier = None
    if fs.exists(spark, target):
        if not fs.exists(spark, side):
            raise FileExistsError(f"{target} is there and is not an export; nothing was published")
        earlier = f"{target}.replaced-{uuid.uuid4().hex}"
        fs.delete(spark, side)
        fs.rename(spark, target, earlier, replace=False)
    fs.rename(spark, result.path, target, replace=False)
    fs.rename(spark, result.sidecar_path, side)
    if earlier:
        fs.delete(spark, earlier)
    return ExportResult(result.job_id, target, side, result.manifest_path,
                        result.row_count, result.n_parts, result.sha256)


def verify_export(spark: SparkSession, result: ExportResult) -> DataFrame:
    """Recompute each part's digest from disk and compare with the manifest.

    Returns the parts whose digest or row count differ (empty when intact).
    """
    recorded = spark.read.parquet(result.manifest_path).alias("m")
    now = read_back_manifest(spark, result.path).alias("d")
    return (recorded.join(now, "bucket", "full")
            .where(~F.coalesce((F.col("m.sha256") == F.col("d.sha256"))
                               & (F.col("m.rows") == F.col("d.rows")), F.lit(False)))
            .select("bucket", F.col("m.sha256").alias("recorded"), F.col("d.sha256").alias("actual")))


def finish_many(spark: SparkSession, root: str, names: dict[str, str],
                parts: dict[str, int], out_dirs: dict[str, str]) -> dict[str, ExportResult]:
    """Manifests and sidecars of many jobs' parts under ``root`` (as written by
    ``write_parts_multi``) in a fixed number of Spark jobs, whatever the
    number of export jobs: one digest read, one record count, one manifest
    table, one sidecar write; per job only folder renames remain."""
    from urllib.parse import unquote

    rel = F.regexp_extract("path", r"job_id=([^/]+)/(bucket=\d+/[^/]+)$", 2)
    job_raw = F.regexp_extract("path", r"job_id=([^/]+)/bucket=\d+/[^/]+$", 1)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.txt").load(root)
             .select(job_raw.alias("job_dir"), rel.alias("file"),
                     F.regexp_extract("path", r"bucket=(\d+)/", 1).cast("int").alias("bucket"),
                     F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"),
                     F.col("path")))
    # Jobs differ in column count; counting records needs only the quoting
    # and line structure, so every record is read into one column.
    records = (spark.read.schema("c string").option("recursiveFileLookup", True)
               .option("header", True).option("multiLine", True).option("escape", '"')
               .option("mode", "PERMISSIVE").option("enforceSchema", True)
               .option("pathGlobFilter", "*.txt").csv(root)
               .select(F.col("_metadata.file_path").alias("path"))
               .groupBy("path").agg(F.count(F.lit(1)).alias("rows")))
    # ``_metadata.file_path`` and ``binaryFile``'s path are the same URI.
    dirs = {unquote(d): d for d in
            [r[0] for r in files.select("job_dir").distinct().collect()]}
    jobs = spark.createDataFrame(
        [(dirs.get(j, j), j, names[j]) for j in names], "job_dir string, job_id string, name string")
    manifest = (files.join(records, "path", "left").join(jobs, "job_dir")
                .select("job_id", "bucket", "file", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                        "bytes", "sha256", "name"))
    mroot = f"{root}/_manifests"
    manifest.write.mode("overwrite").partitionBy("job_id").parquet(mroot)
    manifest = spark.read.parquet(mroot)
    side = manifest.select("job_id", "bucket",
                           F.concat("sha256", F.lit("  "), "name", F.lit("/"), "file").alias("line"))
    sroot = f"{root}/_sidecars"
    (side.repartition("job_id").sortWithinPartitions("job_id", "bucket").select("job_id", "line")
     .write.mode("overwrite").partitionBy("job_id").option("lineSep", "\n").text(sroot))
    summary = {r.job_id: r for r in side.groupBy("job_id").agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "line"))),
                                        lambda x: F.concat(x["line"], F.lit("\n"))), ""), 256)
        .alias("sha256"), F.count(F.lit(1)).alias("n")).collect()}
    totals = {r.job_id: int(r.rows) for r in
              manifest.groupBy("job_id").agg(F.sum("rows").alias("rows")).collect()}
    side_dirs = {}
    fsys, p = fs._fs(spark, sroot)
    for st in fsys.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("job_id="):
            side_dirs[unquote(name[len("job_id="):])] = st.getPath().toString()
    results = {}
    for job_id, n in parts.items():
        out_dir, name = out_dirs[job_id], names[job_id]
        fs.rename(spark, dirs_path(root, dirs, job_id), f"{out_dir}/{name}")
        fs.single_file(spark, side_dirs[job_id], f"{out_dir}/{name}.sha256", "part-*.txt")
        results[job_id] = ExportResult(
            job_id=job_id, path=f"{out_dir}/{name}", sidecar_path=f"{out_dir}/{name}.sha256",
            manifest_path=mroot, row_count=totals.get(job_id, 0), n_parts=n,
            sha256=summary[job_id].sha256)
    return results


def dirs_path(root: str, dirs: dict[str, str], job_id: str) -> str:
    return f"{root}/job_id={dirs.get(job_id, job_id)}"
