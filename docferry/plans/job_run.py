"""One export job end to end (the per-control-record work).

count -> extract (filter, project, render, write parts) -> reconcile
(recounts, one re-extract) -> publish (parts, then sidecar) -> manifest row.

Everything data-sized runs as Spark jobs; the driver holds the job
definition, a few integers and the manifest location.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docferry.functions.render import csv_line, json_line, respace_json
from docferry.operators.export import (
    DEFAULT_ROWS_PER_PART, ExportResult, bucket_of, export_lines, part_count, publish)
from docferry.operators.jobs import JobSpec
from docferry.operators.projection import column_path_list, text_cells
from docferry.operators.reconcile import WAITS, Unreconciled, check_until_equal
from docferry.operators.scan import JOB_TAG, as_view, bind_job
from docferry.sources import fs
from docferry.sources.documents import DocumentView
from docferry.sources.tables import Catalog


@dataclass
class RunOptions:
    staging_root: str
    publish_root: str | None = None
    # A part holds at most about so many rows and bytes of the job's own
    # lines, counted before the write; it is read back whole for its digest.
    rows_per_part: int = DEFAULT_ROWS_PER_PART
    bytes_per_part: int = 64 * 1024 * 1024
    # Beyond so many jobs of a table their queries are indexed (``job_index``);
    # those that an index can't hold share scans by this number, as each adds a
    # predicate to every row's tag list.
    max_jobs_per_scan: int = 64
    ndjson_dir: str | None = None
    guard_formulas: bool = False
    waits: tuple[float, ...] = WAITS
    sleep: Callable[[float], None] = time.sleep


@dataclass
class JobOutcome:
    job_id: str
    row_count: int
    n_parts: int
    sha256: str
    path: str
    sidecar_path: str
    manifest_path: str
    attempts: list[tuple[int, int]]
    reextracted: bool
    ndjson_rows: int | None = None


def _safe(job_id: str) -> str:
    """One path segment per job id: safe ids as they are; others with unsafe
    characters replaced and a short digest of the id appended, so two ids
    never share a folder."""
    import hashlib
    import re

    if re.fullmatch(r"[A-Za-z0-9._-]+", job_id) and job_id not in (".", ".."):
        return job_id
    cleaned = re.sub(r"[^A-Za-z0-9._-]", "_", job_id)
    return f"{cleaned}-{hashlib.md5(job_id.encode('utf-8')).hexdigest()[:8]}"


def check_remote(job_id: str, remote: str) -> None:
    """A name under the publish folder: not empty, no ``.`` or ``..`` segment."""
    segments = [x for x in remote.split("/") if x]
    if not segments or any(x in (".", "..") for x in segments):
        raise ValueError(f"job {job_id}: remote_filename must name a file under the publish folder, not {remote!r}")


def _basename(remote: str, job_id: str) -> str:
    parts = [p for p in remote.split("/") if p not in ("", ".", "..")]
    return parts[-1] if parts else f"{_safe(job_id)}.csv"


def _lines(job: JobSpec, source: DocumentView | DataFrame, *, now: datetime,
           options: RunOptions) -> tuple[DataFrame, Column]:
    """The job's rows as (key, line), and the column that spreads them over
    parts: the document id, or without one the line and its place in the
    file it was read from (which a recomputed task sees again)."""
    view = as_view(source)
    paths = column_path_list(job.columns, job.column_paths, job_id=job.job_id)
    bound, pred = bind_job(view, job.query, paths, now=now)
    bound.frame = bound.frame.where(pred)
    cells = text_cells(bound, job.columns, paths, guard_formulas=options.guard_formulas,
                       job_id=job.job_id)
    key = F.col(f"`{view.id_column}`") if view.id_column else F.lit(None)
    lines = bound.frame.select(key.alias("key"), csv_line(cells).alias("line"), _place())
    return lines, _spread(view)


def _place() -> Column:
    """A row's place in what its task reads; a repeated task sees it again."""
    return F.monotonically_increasing_id().alias("place")


def _spread(view: DocumentView) -> Column:
    """What spreads rows over parts. Without an id a line may be that of very
    many rows, so the row's place goes with it."""
    return F.col("key") if view.id_column else F.struct("line", "place")


def _part_count(rows: int, size: int, options: RunOptions) -> int:
    """Parts for so many rows and bytes; one (header only) for none."""
    if options.bytes_per_part <= 0:
        raise ValueError("bytes_per_part must be positive")
    return max(part_count(rows, options.rows_per_part), -(-size // options.bytes_per_part))


def extract(spark: SparkSession, job: JobSpec, source: DocumentView | DataFrame, *,
            now: datetime, out_dir: str, options: RunOptions) -> ExportResult:
    """Scan, filter, project, render and write one job's export. The number of
    parts follows the rows and bytes that the job selects."""
    lines, key = _lines(job, source, now=now, options=options)
    rows, size = lines.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0))).first()
    n_parts = _part_count(int(rows), int(size), options)
    return export_lines(lines.select(bucket_of(key, n_parts).alias("bucket"), "line"), job.columns,
                        job_id=job.job_id, out_dir=out_dir, n_parts=n_parts,
                        name=_basename(job.remote_filename, job.job_id))


def tee_ndjson(spark: SparkSession, job: JobSpec, source: DocumentView | DataFrame, *,
               now: datetime, path: str) -> int:
    """The job's raw matching documents, one JSON object per line.

    Documents assembled from relations are written whole (each child list
    collected per document)."""
    view = as_view(source)
    if view.variant_root is not None:
        bound, pred = bind_job(view, job.query, [], now=now)
        # An unparsable document is null: it has no line and isn't counted.
        rows = bound.frame.where(pred & F.col(f"`{view.variant_root}`").isNotNull()).select(
            respace_json(F.to_json(F.col(f"`{view.variant_root}`"))).alias("j"))
    else:
        docs = view.nested() if (view.lookups or view.children) else view.root
        flat = DocumentView.of(docs, view.id_column)
        bound, pred = bind_job(flat, job.query, [], now=now)
        rows = bound.frame.where(pred).select(
            json_line(*[F.col(f"`{c}`") for c in docs.columns], schema=docs.schema).alias("j"))
    obs = Observation("ndjson")
    rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite") \
        .option("lineSep", "\n").text(path)
    return int(obs.get["n"])


def run_export(spark: SparkSession, job: JobSpec, catalog: Catalog, *, now: datetime,
               options: RunOptions,
               count_source: Callable[[], int] | None = None) -> JobOutcome:
    """Run one job; raises ``Unreconciled`` (nothing published) when the
    export cannot be reconciled with its source."""
    if options.publish_root:
        check_remote(job.job_id, job.remote_filename)

    def source():
        return catalog.get(job.data_index)

    def count_of(src) -> int:
        bound, pred = bind_job(as_view(src), job.query, [], now=now)
        return bound.frame.where(pred).count()

    # The first count and the first extract read one snapshot (one file
    # listing); tier-1 recounts list the table again; a re-extract takes a
    # new snapshot and the count after it reads that same snapshot.
    state = {"snap": source()}
    first = count_source() if count_source else count_of(state["snap"])
    pending = [first]

    def count_once() -> int:
        if pending:
            return pending.pop()
        if count_source:
            return count_source()
        state["snap"] = source()
        return count_of(state["snap"])

    out_dir = f"{options.staging_root.rstrip('/')}/{_safe(job.job_id)}"

    def do_extract() -> ExportResult:
        done = extract(spark, job, state["snap"], now=now, out_dir=out_dir, options=options)
        catalog.verify(job.data_index)  # a pinned version that changed is an error
        return done

    def do_reextract() -> ExportResult:
        state["snap"] = source()
        result = do_extract()
        pending.append(count_source() if count_source else count_of(state["snap"]))
        return result

    final, checks = check_until_equal(do_extract(), count_once, do_reextract,
                                      waits=options.waits, sleep=options.sleep)
    if not checks[-1].agrees:
        raise Unreconciled(job.job_id, checks)
    catalog.verify(job.data_index)
    # The raw documents of the snapshot that reconciled.
    ndjson_rows = None
    if options.ndjson_dir:
        ndjson_rows = tee_ndjson(spark, job, state["snap"], now=now,
                                 path=f"{options.ndjson_dir.rstrip('/')}/{_safe(job.job_id)}.ndjson")
    if options.publish_root:
        target = f"{options.publish_root.rstrip('/')}/{job.remote_filename.lstrip('/')}"
        final = publish(spark, final, target)
    return JobOutcome(job_id=job.job_id, row_count=final.row_count, n_parts=final.n_parts,
                      sha256=final.sha256, path=final.path, sidecar_path=final.sidecar_path,
                      manifest_path=final.manifest_path,
                      attempts=[(c.source_count, c.written_rows) for c in checks],
                      reextracted=checks[-1].pass_no > 1, ndjson_rows=ndjson_rows)


MANIFEST_SCHEMA = ("job_id string, row_count bigint, n_parts int, sha256 string, path string, "
                   "sidecar_path string, attempts array<struct<source_count:bigint,written_rows:bigint>>, "
                   "reextracted boolean, partition int, offset bigint, finished_at timestamp")


def append_manifest(spark: SparkSession, table_path: str, outcome: JobOutcome, *,
                    partition: int | None = None, offset: int | None = None) -> None:
    """One row per finished export, appended to a manifest table."""
    append_manifests(spark, table_path, [(outcome, partition, offset)])


def append_manifests(spark: SparkSession, table_path: str,
                     finished: list[tuple[JobOutcome, int | None, int | None]]) -> None:
    """The rows of several finished records (outcome, partition, offset), in one
    file that appears as a whole."""
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = []
    for outcome, partition, offset in finished:
        d = asdict(outcome)
        rows.append((d["job_id"], d["row_count"], d["n_parts"], d["sha256"], d["path"], d["sidecar_path"],
                     [(int(a), int(b)) for a, b in d["attempts"]], d["reextracted"], partition, offset, at))
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(table_path)


def run_exports_one_scan(spark: SparkSession, jobs: list[JobSpec], catalog: Catalog, *,
                         now: datetime, options: RunOptions) -> dict[str, JobOutcome]:
    """Build-plan step 8: jobs that read the same table share one count pass
    and one write pass, instead of one scan each.

    Rows are tagged with every job they match; each job keeps its own
    columns, paths, parts and header, so a job's parts are byte-identical to
    what ``run_export`` writes. A job whose written rows do not match its
    count is re-run alone through ``run_export`` (recounts, re-extract,
    mismatch report); the others are published as they are. Strict record
    order (one job after another) is the streaming runner's business.
    """
    from collections import defaultdict

    from docferry.functions.render import header_line
    from docferry.operators.export import finish_many, write_parts_multi
    from docferry.operators import job_index
    from docferry.operators.scan import count_per_job, query_fields, tag_jobs

    by_table: dict[str, list[JobSpec]] = defaultdict(list)
    for j in jobs:
        if options.publish_root:
            check_remote(j.job_id, j.remote_filename)
        by_table[j.data_index].append(j)
    groups = []
    for data_index, members in by_table.items():
        step = max(1, options.max_jobs_per_scan)
        index = None
        view = as_view(catalog.get(data_index))
        if len(members) > step and not view.lookups and not view.children and view.variant_root is None:
            jobs_table = spark.createDataFrame([(j.job_id, json.dumps(j.query)) for j in members],
                                               "job_id string, query string")
            index = job_index.build(jobs_table, view.root.schema, now,
                                    f"{options.staging_root.rstrip('/')}/_index/{_safe(data_index)}")
            left_out = {r.job_id for r in index.unsupported.collect()}
            groups.append((data_index, [j for j in members if j.job_id not in left_out], index))
            members = [j for j in members if j.job_id in left_out]
        groups += [(data_index, members[i:i + step], None) for i in range(0, len(members), step)]
    outcomes: dict[str, JobOutcome] = {}
    for gi, (data_index, group, index) in enumerate(groups):
        if not group:
            continue
        ids = [j.job_id for j in group]
        if len(set(ids)) != len(ids):
            raise ValueError(f"duplicate job ids over {data_index}")
        snap = catalog.get(data_index)
        view = as_view(snap)
        specs = [(j.job_id, j.query) for j in group]
        paths = {j.job_id: column_path_list(j.columns, j.column_paths, job_id=j.job_id)
                 for j in group}
        all_paths = [p for ps in paths.values() for p in ps]
        if index is not None:
            fields = [f for _, q in specs for f in query_fields(q)]
            bound = view.bind(list(dict.fromkeys([*all_paths, *fields])))
            tagged = job_index.tag(bound.frame, index)
        else:
            bound, tagged = tag_jobs(view, specs, now=now, paths=all_paths)
        bound.frame = tagged
        # One line expression per distinct (columns, paths) and one bucket
        # expression per distinct part count, chosen by job id: jobs that
        # export the same columns share one expression.
        by_spec: dict[tuple, list[str]] = defaultdict(list)
        for j in group:
            by_spec[(tuple(j.columns), tuple(paths[j.job_id]))].append(j.job_id)
        line = None
        for (cols, ps), members in by_spec.items():
            cells = text_cells(bound, list(cols), list(ps), guard_formulas=options.guard_formulas,
                               job_id=members[0])
            this_line = csv_line(cells)
            if len(by_spec) == 1:
                line = this_line
                break
            cond = F.col(JOB_TAG).isin(members)
            line = F.when(cond, this_line) if line is None else line.when(cond, this_line)
        key = F.col(f"`{view.id_column}`") if view.id_column else F.lit(None)
        keyed = tagged.select(F.col(JOB_TAG).alias("job_id"), key.alias("key"), line.alias("line"), _place())
        # One row for each job of the group: source count, rows and bytes of its lines.
        if index is not None:
            found = job_index.tag(view.root, index).groupBy(F.col(JOB_TAG).alias("job_id")).agg(
                F.count(F.lit(1)).alias("source_count"))
            counts = dict.fromkeys(ids, 0) | {r.job_id: int(r.source_count) for r in found.collect()}
        else:
            counts = {r.job_id: int(r.source_count) for r in count_per_job(view, specs, now=now).collect()}
        sizes = {r.job_id: int(r.size) for r in keyed.groupBy("job_id").agg(
            F.sum(F.octet_length("line") + 1).alias("size")).collect()}
        parts = {j.job_id: _part_count(counts[j.job_id], sizes.get(j.job_id, 0), options) for j in group}
        # One row for each job of the group.
        n_of = spark.createDataFrame(list(parts.items()), "job_id string, n_parts int")
        bucket = F.pmod(F.xxhash64(_spread(view)), F.col("n_parts")).cast("int")
        lines = keyed.join(F.broadcast(n_of), "job_id").select("job_id", bucket.alias("bucket"), "line")
        headers = {j.job_id: header_line(j.columns) for j in group}
        root = f"{options.staging_root.rstrip('/')}/_one_scan/{_safe(data_index)}-{gi}"
        write_parts_multi(lines, headers, parts, root)
        names = {j.job_id: _basename(j.remote_filename, j.job_id) for j in group}
        out_dirs = {j.job_id: f"{options.staging_root.rstrip('/')}/{_safe(j.job_id)}" for j in group}
        results = finish_many(spark, root, names, parts, out_dirs)
        tees = {}
        if options.ndjson_dir:
            for j in group:
                tees[j.job_id] = tee_ndjson(
                    spark, j, snap, now=now,
                    path=f"{options.ndjson_dir.rstrip('/')}/{_safe(j.job_id)}.ndjson")
        for j in group:
            result = results[j.job_id]
            if result.row_count != counts[j.job_id]:
                outcomes[j.job_id] = run_export(spark, j, catalog, now=now, options=options)
                continue
            final = result
            if options.publish_root:
                target = f"{options.publish_root.rstrip('/')}/{j.remote_filename.lstrip('/')}"
                final = publish(spark, final, target)
            outcomes[j.job_id] = JobOutcome(
                job_id=j.job_id, row_count=final.row_count, n_parts=final.n_parts,
                sha256=final.sha256, path=final.path, sidecar_path=final.sidecar_path,
                manifest_path=final.manifest_path,
                attempts=[(counts[j.job_id], final.row_count)], reextracted=False,
                ndjson_rows=tees.get(j.job_id))
    return outcomes


def run_one(spark: SparkSession, job_doc_id: str, jobs: DataFrame, catalog: Catalog, *,
            now: datetime, options: RunOptions, manifest_path: str | None = None) -> JobOutcome:
    """One control record's work without the stream: load and validate the
    job, export, reconcile, publish, and append the manifest row."""
    from docferry.operators.jobs import load_job

    job = load_job(jobs, job_doc_id)
    outcome = run_export(spark, job, catalog, now=now, options=options)
    if manifest_path:
        append_manifest(spark, manifest_path, outcome)
    return outcome
