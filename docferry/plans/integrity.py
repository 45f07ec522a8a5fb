"""Registered queries: set reconciliation (R4), retries (R2, R3), pinned
versions (S4), the control stream (S1, T5-T9), ordered records (T7, T8) and pages by index (K2, K3)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.operators.paging import page_index, read_page
from docferry.operators.reconcile import check_until_equal, checks_frame
from docferry.operators.set_reconcile import differences
from docferry.plans.control_jobs import _DECODE_SQL, control_records
from docferry.session import checkpoint_dir
from docferry.sources.snapshots import SnapshotChanged, SnapshotLog
from docferry.sources.tables import driver_catalog, read_table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
PAGE = 1000


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/integrity/{name}-{uuid.uuid4().hex}"


def reconcile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that an export lost, wrote twice or made up."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    written = orders.filter("id % 1009 != 0").unionByName(orders.filter("id % 3001 = 0")).unionByName(
        orders.filter("id % 2003 = 0").selectExpr("id + 1000000000 AS id"))
    return differences(written, orders, "id")


class _Rows:
    def __init__(self, row_count: int) -> None:
        self.row_count = row_count


def reconcile_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a source that catches up with its export while it
    is counted again, and of one that needs the export to be written anew."""
    orders = read_table(spark, sf_dir, "orders")
    shares = iter([2, 3, 5])
    total = orders.count()
    _, late = check_until_equal(_Rows(total), lambda: orders.filter(F.col("o_orderkey") % 5 < next(shares)).count(),
                                lambda: _Rows(total), sleep=lambda s: None)
    small = orders.filter("o_orderkey % 5 < 2")
    _, again = check_until_equal(_Rows(small.count()), orders.count, lambda: _Rows(orders.count()),
                                 waits=(1.0, 2.0), sleep=lambda s: None)
    return checks_frame(spark, "late", late).unionByName(checks_frame(spark, "again", again))


def snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each version of a table that grows and is rewritten, read by
    version, and whether the version's files still stand at the end."""
    root = _scratch(spark, "versions")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    path = f"{root}/table"
    log = SnapshotLog(spark, path, f"{root}/log")
    counts = []
    for mode, some in (("overwrite", "c_nationkey < 10"), ("append", "c_nationkey >= 10"), ("overwrite", "c_nationkey < 5")):
        customers.filter(some).write.mode(mode).parquet(path)
        version = log.pin()
        counts.append((version, log.read(version).count()))
    # A version whose files didn't change is the same version.
    counts.append((log.pin(), counts[-1][1]))
    rows = []
    for version, n in dict(counts).items():
        try:
            log.verify(version)
            rows.append((version, n, True))
        except SnapshotChanged:
            rows.append((version, n, False))
    return spark.createDataFrame(rows, "version int, n bigint, stands boolean")


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest control record of each job and shape, run as a
    stream, and all of them once more as a replay: finished records and dead
    letters, each once."""
    from docferry.plans.job_run import RunOptions
    from docferry.streaming.control_stream import StreamConfig, file_control_source, start

    root = _scratch(spark, "stream")
    events = read_table(spark, sf_dir, "events")
    latest = events.groupBy(F.col("user_id") % 30, F.col("event_id") % 9).agg(F.max("event_id").alias("offset"))
    (control_records(spark, sf_dir).join(latest.select("offset"), "offset", "left_semi")
     .select("value", "partition", "offset").repartition(3, "partition").write.parquet(f"{root}/control"))
    nation = F.col("id").cast("string")
    jobs = spark.range(30).select(
        F.concat(F.lit("job-"), nation).alias("_id"),
        F.concat(F.lit('{"job_id": "job-'), nation, F.lit('", "data_index": "customer", "query": {"term": {"c_nationkey": '),
                 nation, F.lit('}}, "columns": ["c_custkey", "c_name"], "remote_filename": "n/'), nation,
                 F.lit('.csv"}')).alias("doc"))
    cfg = StreamConfig(jobs=lambda: jobs, catalog=driver_catalog(spark, sf_dir),
                       options=RunOptions(staging_root=f"{root}/stage", publish_root=f"{root}/out"),
                       ledger_path=f"{root}/ledger", dead_letter_path=f"{root}/dead",
                       clock=lambda: datetime(2024, 1, 31), strict_order=False)
    for run in ("first", "replay"):
        start(spark, file_control_source(spark, f"{root}/control", max_files_per_trigger=100), cfg,
              checkpoint=f"{root}/offsets-{run}").awaitTermination()
    done = spark.read.parquet(cfg.ledger_path).select(
        "partition", "offset", "job_id", "row_count", F.lit(None).cast("string").alias("error"))
    dead = spark.read.parquet(cfg.dead_letter_path).select(
        "partition", "offset", F.lit(None).cast("string").alias("job_id"), F.lit(None).cast("bigint").alias("row_count"),
        "error").distinct()
    return done.unionByName(dead)


def stream_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of every event, delivered late and twice, passed on once
    each and in offset order by a stream that is stopped and started again."""
    from docferry.streaming.control_stream import file_control_source
    from docferry.streaming.in_order import in_order, state_settings

    root = _scratch(spark, "in-order")
    events = read_table(spark, sf_dir, "events")
    first, n = events.agg(F.min("event_id"), F.count(F.lit(1))).first()
    at = F.col("event_id") - F.lit(first)
    records = events.select(F.encode(F.concat_ws("|", "event_type", F.col("event_id").cast("string")), "UTF-8").alias("value"),
                            (at % 16).cast("int").alias("partition"), F.expr("0L").alias("offset"), at.alias("i"))
    records = records.withColumn("offset", F.floor(F.col("i") / 16).cast("long"))
    # Files follow one another in time; some records are in the next one or in both.
    file = F.least(F.floor(F.col("i") * 6 / F.lit(n)), F.lit(5)).cast("int")
    late = records.withColumn("file", F.when(F.col("i") % 1013 == 5, F.least(file + 1, F.lit(5))).otherwise(file))
    again = records.where("i % 7 = 3").withColumn("file", F.least(file + 1, F.lit(5)))
    sent = late.unionByName(again).select("value", "partition", "offset", "file")
    for part, some in enumerate(("file < 3", "file >= 3")):
        sent.where(some).repartition("file").write.partitionBy("file").mode("append").parquet(f"{root}/sent")

        def write(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

        stream = file_control_source(spark, f"{root}/sent", max_files_per_trigger=2)
        with state_settings(spark, 8, wait_for_timers=False):
            (in_order(stream).writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/state")
             .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out").select(
        "partition", "offset", F.decode("value", "UTF-8").alias("value"), "seq", "skipped")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(*KEYS, "l_quantity")


def page_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the first key of every page."""
    return page_index(_lines(spark, sf_dir), KEYS, PAGE)


def pages_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3: the first, fourth and last page and the one after it, each read
    by its keys alone."""
    lines = _lines(spark, sf_dir)
    path = _scratch(spark, "pages")
    page_index(lines, KEYS, PAGE).write.parquet(path)
    index = spark.read.parquet(path)
    last = index.agg(F.max("page")).first()[0]
    out = None
    for n in sorted({0, 3, last, last + 1}):
        page = read_page(lines, KEYS, index, n).withColumn("page", F.lit(n).cast("bigint"))
        out = page if out is None else out.unionByName(page)
    return out


_PAGES = f"""SELECT *, CAST(floor((row_number() OVER (ORDER BY {', '.join(KEYS)}) - 1) / {PAGE}) AS BIGINT) AS page,
  (row_number() OVER (ORDER BY {', '.join(KEYS)}) - 1) % {PAGE} AS i FROM lineitem"""

QUERIES = {
    "reconcile_ids": (reconcile_ids, lambda: """SELECT id, CAST(sum(n) AS BIGINT) AS surplus FROM (
  SELECT o_orderkey AS id, -1 AS n FROM orders
  UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 1009 <> 0
  UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 3001 = 0
  UNION ALL SELECT o_orderkey + 1000000000, 1 FROM orders WHERE o_orderkey % 2003 = 0)
GROUP BY id HAVING sum(n) <> 0"""),
    "reconcile_retries": (reconcile_retries, lambda: """WITH n AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE o_orderkey % 5 < 2) AS two, count(*) FILTER (WHERE o_orderkey % 5 < 3) AS three FROM orders),
c AS (
  SELECT 'late' AS job_id, 1 AS attempt, two AS source_count, n AS written_rows, 1 AS pass_no FROM n
  UNION ALL SELECT 'late', 2, three, n, 1 FROM n UNION ALL SELECT 'late', 3, n, n, 1 FROM n
  UNION ALL SELECT 'again', 1, n, two, 1 FROM n UNION ALL SELECT 'again', 2, n, two, 1 FROM n
  UNION ALL SELECT 'again', 3, n, two, 1 FROM n UNION ALL SELECT 'again', 4, n, n, 2 FROM n)
SELECT *, source_count = written_rows AS matched FROM c"""),
    "snapshot_versions": (snapshot_versions, lambda: """SELECT CAST(v AS INTEGER) AS version,
  count(*) FILTER (WHERE CASE v WHEN 0 THEN c_nationkey < 10 WHEN 1 THEN true ELSE c_nationkey < 5 END) AS n,
  v = 2 AS stands FROM customer, range(3) t(v) GROUP BY v"""),
    "stream_ledger": (stream_ledger, lambda: f"""WITH r AS (
  SELECT d.*, user_id FROM ({_DECODE_SQL}) d JOIN events e ON e.event_id = d."offset"
  WHERE d."offset" IN (SELECT max(event_id) FROM events GROUP BY user_id % 30, event_id % 9))
SELECT partition, "offset", job_doc_id AS job_id, CASE WHEN error IS NULL THEN
  (SELECT count(*) FROM customer WHERE c_nationkey = user_id % 30) END AS row_count, error FROM r"""),
    "stream_in_order": (stream_in_order, lambda: """WITH r AS (
  SELECT event_id - (SELECT min(event_id) FROM events) AS i, event_type, event_id FROM events)
SELECT CAST(i % 16 AS INTEGER) AS partition, i // 16 AS "offset", event_type || '|' || CAST(event_id AS VARCHAR) AS value,
  row_number() OVER (PARTITION BY i % 16 ORDER BY i) - 1 AS seq, CAST(0 AS BIGINT) AS skipped FROM r"""),
    "page_boundaries": (page_boundaries, lambda: f"SELECT page, {', '.join(KEYS)} FROM ({_PAGES}) WHERE i = 0"),
    "pages_by_index": (pages_by_index, lambda: f"""WITH p AS ({_PAGES})
SELECT {', '.join(KEYS)}, l_quantity, page FROM p WHERE page IN (0, 3, (SELECT max(page) FROM p))"""),
}
