"""Registered queries: CSV rendering (V1-V5), NDJSON (V7, W3/W4), digests
(V3, A3), many-jobs export and reconciliation (F5, J4, R1, R4)."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.render import header_line, json_line
from docferry.operators.export import bucket_digests, export_lines, int_bucket, part_count, verify_export
from docferry.operators.jobs import JobSpec
from docferry.operators.projection import project, text_cells, with_line
from docferry.operators.reconcile import pair_counts
from docferry.operators.scan import JOB_TAG, as_view, count_per_job, tag_jobs, tag_jobs_by_value
from docferry.plans.filters import NOW
from docferry.plans.projections import ORDER_EXPORT_COLUMNS, ORDER_EXPORT_PATHS
from docferry.plans.sqltext import ITEMS_CTE, csv_line_sql, txt
from docferry.sources.documents import event_documents, order_documents
from docferry.session import checkpoint_dir
from docferry.sources.tables import driver_catalog, read_table


def csv_line_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts (quotes, commas, line breaks) as CSV records."""
    cols = ["doc_id", "lang", "text"]
    rows = project(read_table(spark, sf_dir, "documents"), cols)
    return with_line(rows, cols).select("doc_id", "line")


def csv_line_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["page_id", "url", "html"]
    rows = project(read_table(spark, sf_dir, "pages"), cols)
    return with_line(rows, cols).select("page_id", "line")


def csv_single_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-column export: an empty cell is written as ``""``."""
    cols = ["turn_text"]
    docs = read_table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("turn_text"))
    rows = project(docs, cols, keep=["conv_id", "turn"])
    return with_line(rows, cols).select(
        F.col("__keep_0").alias("conv_id"), F.col("__keep_1").alias("turn"), "line")


def formula_guard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cells starting = + - @ get a leading quote; numbers never do."""
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_size") % 5
    label = (F.when(k == 0, F.concat(F.lit("="), "p_name"))
             .when(k == 1, F.concat(F.lit("+"), "p_brand"))
             .when(k == 2, F.concat(F.lit("-"), "p_type"))
             .when(k == 3, F.concat(F.lit("@"), "p_name"))
             .otherwise(F.col("p_name")))
    docs = part.select("p_partkey", label.alias("label"), (-F.col("p_size")).alias("neg_size"))
    cols = ["p_partkey", "label", "neg_size"]
    return with_line(project(docs, cols, guard_formulas=True), cols)


def _formula_guard_sql() -> str:
    label = """CASE p_size % 5 WHEN 0 THEN '=' || p_name WHEN 1 THEN '+' || p_brand
      WHEN 2 THEN '-' || p_type WHEN 3 THEN '@' || p_name ELSE p_name END"""
    return f"""WITH c AS (SELECT {txt('p_partkey')} AS p_partkey,
    CASE WHEN regexp_matches(lbl, '^[=+\\-@]') THEN '''' || lbl ELSE lbl END AS label,
    {txt('-p_size')} AS neg_size
  FROM (SELECT *, {label} AS lbl FROM part))
SELECT *, {csv_line_sql(['p_partkey', 'label', 'neg_size'])} AS line FROM c"""


def ndjson_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: one JSON object per document (every field, nulls kept), laid out
    like Python's ``json.dumps``."""
    ev = read_table(spark, sf_dir, "events")
    fields = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return ev.select("event_id", json_line(*[F.col(c) for c in fields],
                                           schema=ev.select(*fields).schema).alias("json"))


def csv_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/V3: per-part digests of the flagship export.

    Parts hold ``rows_per_part`` orders each on average (the part count
    comes from the source count; order ids are spread by a multiplicative
    mix before ``mod n``), so a digest never needs more than one part's lines
    in one task.
    """
    view = order_documents(spark, sf_dir)
    n = part_count(view.root.count(), DIGEST_ROWS_PER_PART)
    rows = project(view, ORDER_EXPORT_COLUMNS, ORDER_EXPORT_PATHS, keep=["order_id"])
    lines = with_line(rows, ORDER_EXPORT_COLUMNS).select(
        int_bucket(F.col("__keep_0"), n).alias("bucket"), "line")
    return bucket_digests(lines, header_line(ORDER_EXPORT_COLUMNS)).select(
        "bucket", F.col("rows").cast("bigint").alias("rows"), "sha256")


DIGEST_ROWS_PER_PART = 4096


def _written_orders(spark: SparkSession, sf_dir: str):
    """The flagship export, written in parts: its result."""
    view = order_documents(spark, sf_dir)
    n = part_count(view.root.count(), DIGEST_ROWS_PER_PART)
    rows = project(view, ORDER_EXPORT_COLUMNS, ORDER_EXPORT_PATHS, keep=["order_id"])
    lines = with_line(rows, ORDER_EXPORT_COLUMNS).select(
        int_bucket(F.col("__keep_0"), n).alias("bucket"), "line")
    return export_lines(lines, ORDER_EXPORT_COLUMNS, job_id="orders", out_dir=_scratch(spark, "orders"),
                        n_parts=n, name="orders.csv")


def export_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written parts, counted and digested from the files."""
    done = _written_orders(spark, sf_dir)
    return spark.read.parquet(done.manifest_path).select("bucket", "rows", "sha256")


def sidecar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sidecar beside the parts, one digest for each."""
    done = _written_orders(spark, sf_dir)
    line = F.split("value", "  ")
    return spark.read.text(done.sidecar_path).select(
        F.regexp_extract(line[1], r"bucket=(\d+)/", 1).cast("int").alias("bucket"), line[0].alias("sha256"))


def verify_export_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as recorded, and whether the files still have that digest."""
    done = _written_orders(spark, sf_dir)
    bad = verify_export(spark, done).select(F.col("bucket").alias("bad"))
    return (spark.read.parquet(done.manifest_path).join(bad, F.col("bucket") == F.col("bad"), "left")
            .select("bucket", "rows", F.col("bad").isNull().alias("intact")))


SEGMENT_JOB = JobSpec(job_id="building", data_index="customer", query={"term": {"c_mktsegment": "BUILDING"}},
                      columns=["c_custkey", "c_name"], remote_filename="building.csv")


def _run_segment(spark: SparkSession, sf_dir: str, root: str):
    from docferry.plans.job_run import RunOptions, run_export

    return run_export(spark, SEGMENT_JOB, driver_catalog(spark, sf_dir), now=NOW,
                      options=RunOptions(staging_root=f"{root}/stage", publish_root=f"{root}/out",
                                         ndjson_dir=f"{root}/raw"))


def ndjson_tee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw documents of a job, as its run wrote them."""
    root = _scratch(spark, "tee")
    done = _run_segment(spark, sf_dir, root)
    return spark.read.text(f"{root}/raw/{done.job_id}.ndjson").select(F.col("value").alias("json"))


def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result record of a finished job run."""
    from docferry.plans.job_run import append_manifest

    root = _scratch(spark, "manifest")
    append_manifest(spark, f"{root}/manifest", _run_segment(spark, sf_dir, root))
    last = F.element_at("attempts", -1)
    return spark.read.parquet(f"{root}/manifest").select(
        "job_id", "row_count", last["source_count"].alias("source_count"), "reextracted")


def _csv_digest_sql() -> str:
    cells = [txt("o.o_orderkey"), txt("c.c_name"),
             txt("CAST(round(o.o_totalprice * 100) AS BIGINT)"), txt("i0.l_partkey")]
    header = header_line(ORDER_EXPORT_COLUMNS)
    return f"""WITH {ITEMS_CTE},
lines AS (
  SELECT o.o_orderkey AS k, {csv_line_sql(cells)} AS line
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1),
n AS (SELECT greatest(1, CAST(ceil(count(*) / {DIGEST_ROWS_PER_PART}.0) AS BIGINT)) AS n FROM orders)
SELECT CAST((((k % 2147483647) * 16807) % 2147483647) % n AS INTEGER) AS bucket, count(*) AS rows,
  sha256('{header}' || chr(10) || string_agg(line, chr(10) ORDER BY line) || chr(10)) AS sha256
FROM lines, n GROUP BY 1"""


# ---------------------------------------------------------------------------
# Many jobs over one table: one job per nation over customers.
# ---------------------------------------------------------------------------

CUSTOMER_COLUMNS = ["c_custkey", "name", "segment", "balance"]
CUSTOMER_PATHS = {"name": "c_name", "segment": "c_mktsegment", "balance": "c_acctbal"}


def nation_job_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job table: one term job per nation (job_id, value)."""
    key = F.col("n_nationkey")
    return read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation-"), key.cast("string")).alias("job_id"), key.alias("value"))


def nation_jobs(spark: SparkSession, sf_dir: str) -> list[tuple[str, dict]]:
    """The same jobs as queries (a few dozen, for the one-scan runner)."""
    return [(r.job_id, {"term": {"c_nationkey": r.value}})
            for r in nation_job_table(spark, sf_dir).orderBy("value").collect()]


def multi_job_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step 8: every nation job's CSV lines from one scan of customer."""
    tagged = tag_jobs_by_value(read_table(spark, sf_dir, "customer"), "c_nationkey", nation_job_table(spark, sf_dir))
    paths = [CUSTOMER_PATHS.get(c, c) for c in CUSTOMER_COLUMNS]
    bound = as_view(tagged).bind(paths)
    rows = bound.frame.select(F.col(JOB_TAG).alias("job_id"), *text_cells(bound, CUSTOMER_COLUMNS, paths))
    return with_line(rows, CUSTOMER_COLUMNS).select("job_id", "line")


def _multi_job_export_sql() -> str:
    cells = [txt("c_custkey"), txt("c_name"), txt("c_mktsegment"), txt("c_acctbal")]
    return f"""SELECT 'nation-' || CAST(n_nationkey AS VARCHAR) AS job_id, {csv_line_sql(cells)} AS line
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + R1: each job's source count against the rows of its written parts
    (the jobs are exported, and the files read back)."""
    jobs = nation_job_table(spark, sf_dir)
    counted = read_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    expected = jobs.join(counted, F.col("value") == F.col("c_nationkey"), "left").select(
        "job_id", F.coalesce("n", F.lit(0)).alias("source_count"))
    path = _scratch(spark, "nations")
    (multi_job_export(spark, sf_dir).repartition("job_id", F.pmod(F.xxhash64("line"), F.lit(64))).write.partitionBy("job_id")
     .option("lineSep", "\n").text(path))
    written = (spark.read.schema("c string, job_id string").option("multiLine", True).option("escape", '"').csv(path)
               .groupBy("job_id").agg(F.count(F.lit(1)).alias("written_rows")))
    return pair_counts(expected, written)


def _reconcile_counts_sql() -> str:
    return """SELECT 'nation-' || CAST(n_nationkey AS VARCHAR) AS job_id,
  CAST(count(c_custkey) AS BIGINT) AS source_count, CAST(count(c_custkey) AS BIGINT) AS written_rows,
  true AS matched
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey"""


# Moving-window jobs counted and extracted at different clocks
# (the race that a job-run clock shared by count and extract removes).
WINDOW_JOBS = [(f"events-{t}-3d", {"bool": {"filter": [
    {"term": {"event_type": t}}, {"range": {"ts": {"gte": "now-3d"}}}]}})
    for t in ("click", "view", "purchase", "signup", "error")]
EXTRACT_LAG = timedelta(hours=12)


def reconcile_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken at ``NOW``, rows extracted at ``NOW - 12h`` — every job
    with events in the 12 hours between the two windows' starts mismatches."""
    view = event_documents(spark, sf_dir)
    expected = count_per_job(view, WINDOW_JOBS, now=NOW)
    _, tagged = tag_jobs(view, WINDOW_JOBS, now=NOW - EXTRACT_LAG)
    written = tagged.groupBy(F.col(JOB_TAG).alias("job_id")).agg(F.count(F.lit(1)).alias("written_rows"))
    return pair_counts(expected, written).withColumn(
        "difference", F.col("source_count") - F.col("written_rows"))


def _reconcile_mismatch_sql() -> str:
    parts = []
    for t in ("click", "view", "purchase", "signup", "error"):
        parts.append(f"""SELECT 'events-{t}-3d' AS job_id,
  CAST(count(*) FILTER (WHERE event_type = '{t}' AND ts >= TIMESTAMP '2024-01-28 00:00:00') AS BIGINT) AS source_count,
  CAST(count(*) FILTER (WHERE event_type = '{t}' AND ts >= TIMESTAMP '2024-01-27 12:00:00') AS BIGINT) AS written_rows
FROM events""")
    return f"""SELECT *, source_count = written_rows AS matched, source_count - written_rows AS difference
FROM ({' UNION ALL '.join(parts)})"""


QUERIES = {
    "csv_line_render": (csv_line_render, lambda: f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id,
  {csv_line_sql([txt('doc_id'), txt('lang'), txt('text')])} AS line FROM documents"""),
    "csv_line_pages": (csv_line_pages, lambda: f"""SELECT CAST(page_id AS VARCHAR) AS page_id,
  {csv_line_sql([txt('page_id'), txt('url'), txt('html')])} AS line FROM pages"""),
    "csv_single_column": (csv_single_column, lambda: f"""SELECT conv_id, turn,
  {csv_line_sql(["coalesce(CASE WHEN role = 'system' THEN '' ELSE text END, '')"])} AS line
FROM conversations"""),
    "formula_guard": (formula_guard_query, _formula_guard_sql),
    "ndjson_dump": (ndjson_dump, lambda: """SELECT event_id,
  '{"event_id": ' || coalesce(CAST(event_id AS VARCHAR), 'null')
  || ', "ts": ' || coalesce('"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"', 'null')
  || ', "user_id": ' || coalesce(CAST(user_id AS VARCHAR), 'null')
  || ', "event_type": ' || coalesce(CAST(to_json(event_type) AS VARCHAR), 'null')
  || ', "value": ' || coalesce(CAST(value AS VARCHAR), 'null')
  || ', "props": ' || coalesce(CAST(to_json(props) AS VARCHAR), 'null') || '}' AS json
FROM events"""),
    "csv_digest": (csv_digest, _csv_digest_sql),
    "export_parts": (export_parts, _csv_digest_sql),
    "sidecar_lines": (sidecar_lines, lambda: f"SELECT bucket, sha256 FROM ({_csv_digest_sql()})"),
    "verify_export": (verify_export_query, lambda: f"SELECT bucket, rows, true AS intact FROM ({_csv_digest_sql()})"),
    "ndjson_tee": (ndjson_tee, lambda: """SELECT '{"c_custkey": ' || CAST(c_custkey AS VARCHAR)
  || ', "c_name": ' || CAST(to_json(c_name) AS VARCHAR) || ', "c_nationkey": ' || CAST(c_nationkey AS VARCHAR)
  || ', "c_acctbal": ' || CAST(c_acctbal AS VARCHAR)
  || ', "c_mktsegment": ' || CAST(to_json(c_mktsegment) AS VARCHAR) || '}' AS json
FROM customer WHERE c_mktsegment = 'BUILDING'"""),
    "export_manifest": (export_manifest, lambda: """SELECT 'building' AS job_id, count(*) AS row_count,
  count(*) AS source_count, false AS reextracted FROM customer WHERE c_mktsegment = 'BUILDING'"""),
    "multi_job_export": (multi_job_export, _multi_job_export_sql),
    "reconcile_counts": (reconcile_counts, _reconcile_counts_sql),
    "reconcile_mismatch": (reconcile_mismatch, _reconcile_mismatch_sql),
}

