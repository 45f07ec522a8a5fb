"""Registered queries: control records (T1-T3, V6, V9), jobs (J1-J3),
delivery plans (V8, W5).

Control records and job documents are derived from the driver tables:
one control record per event, one export job per nation. The record shape
is chosen by ``event_id % 9`` and the job shape by ``n_nationkey % 6``, so
every decode and validation rule is exercised at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.operators.control import decode_control, split_control
from docferry.operators.jobs import delivery_plan, lookup_jobs, validate_jobs
from docferry.sources.tables import read_table

STAGING_ROOT = "/exports/staging"


def control_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value binary, partition, offset): one control record per event."""
    ev = read_table(spark, sf_dir, "events")
    kind = F.col("event_id") % 9
    job = F.concat(F.lit("job-"), (F.col("user_id") % 30).cast("string"))
    eid = F.col("event_id").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit('{"job_doc_id": "'), job,
                                   F.lit('", "correlation_id": "c-'), eid, F.lit('"}')))
        .when(kind == 1, F.concat(F.lit('{"id": "'), job, F.lit('"}')))
        .when(kind == 3, F.concat(F.lit("not json "), eid))
        .when(kind == 4, F.concat(F.lit("["), eid, F.lit("]")))
        .when(kind == 5, F.concat(F.lit('{"job_doc_id": '), eid, F.lit("}")))
        .when(kind == 6, F.concat(F.lit('{"job_doc_id": "'), job, F.lit('", "correlation_id": 7}')))
        .when(kind == 7, F.concat(F.lit('{"job_doc_id": "", "id": "'), job,
                                  F.lit('", "correlation_id": null}'))))
    value = (F.when(kind == 2, F.lit(None).cast("binary"))
             .when(kind == 8, F.unhex(F.lit("FF41")))
             .otherwise(F.encode(text, "UTF-8")))
    return ev.select(value.alias("value"), (F.col("event_id") % 3).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"))


def job_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(_id, doc): one export job per nation, some deliberately broken."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    key = F.col("n_nationkey").cast("string")
    kind = F.col("n_nationkey") % 6
    query = F.concat(F.lit('{"term": {"c_nationkey": '), key, F.lit("}}"))
    remote = F.concat(F.lit("exports/"), F.lower("r_name"), F.lit("/"), F.lower("n_name"), F.lit(".csv"))
    remote = F.when(F.col("n_nationkey") == 7, F.lit("")).otherwise(remote)
    columns = F.when(F.col("n_nationkey") == 11, F.lit("[]")).otherwise(
        F.lit('["c_custkey", "name", "segment", "balance"]'))
    paths = F.lit('{"name": "c_name", "segment": "c_mktsegment", "balance": "c_acctbal"}')
    doc = (
        F.when(kind == 0, F.concat(
            F.lit('{"job_id": "nation-'), key, F.lit('", "data_index": "customer", "query": '), query,
            F.lit(', "columns": '), columns, F.lit(', "column_paths": '), paths,
            F.lit(', "remote_filename": "'), remote, F.lit('"}')))
        .when(kind == 1, F.concat(
            F.lit('{"data_index": "customer", "query": '), query,
            F.lit(', "columns": ["c_custkey", "c_name"], "column_paths": null, "remote_filename": "'),
            remote, F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"data_index": "customer", "query": '), query,
                                  F.lit(', "remote_filename": "'), remote, F.lit('"}')))
        .when(kind == 3, F.concat(
            F.lit('{"job_id": 1'), key, F.lit(', "data_index": "customer", "query": ["not", "a", "dict"], '
                                             '"columns": ["c_custkey"], "remote_filename": "'),
            remote, F.lit('"}')))
        .when(kind == 4, F.concat(
            F.lit('{"data_index": "customer", "query": '), query,
            F.lit(', "columns": ["a", 1, "b"], "remote_filename": "'), remote, F.lit('"}')))
        .otherwise(F.concat(
            F.lit('{"job_id": null, "data_index": "customer", "query": '), query,
            F.lit(', "columns": ["c_custkey"], "column_paths": {"c_custkey": 5}, "remote_filename": "'),
            remote, F.lit('"}'))))
    return nr.select(F.concat(F.lit("job-"), key).alias("_id"), doc.alias("doc"))


def control_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_control(control_records(spark, sf_dir))


def control_poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = split_control(decode_control(control_records(spark, sf_dir)))
    return rejects.select("partition", "offset", "error")


def job_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate_jobs(job_table(spark, sf_dir))
    return v.select("job_doc_id", "job_id", "data_index", "remote_filename",
                    F.array_join("columns", "|").alias("columns"),
                    F.size("column_paths").alias("n_paths"), "error")


def job_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = split_control(decode_control(control_records(spark, sf_dir)))
    return lookup_jobs(ok, job_table(spark, sf_dir)).select(
        "partition", "offset", "job_doc_id", "correlation_id", "job_id", "data_index", "error")


def delivery_plan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_plan(validate_jobs(job_table(spark, sf_dir)), STAGING_ROOT)


_KIND = "event_id % 9"
_JOB = "'job-' || CAST(user_id % 30 AS VARCHAR)"

_DECODE_SQL = f"""SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id AS "offset",
  CASE WHEN {_KIND} IN (0, 1, 7) THEN {_JOB} END AS job_doc_id,
  CASE WHEN {_KIND} = 0 THEN 'c-' || CAST(event_id AS VARCHAR) END AS correlation_id,
  CASE {_KIND} WHEN 2 THEN 'null_value' WHEN 3 THEN 'undecodable' WHEN 8 THEN 'undecodable'
    WHEN 4 THEN 'not_an_object' WHEN 5 THEN 'missing_job_doc_id'
    WHEN 6 THEN 'bad_correlation_id' END AS error
FROM events"""

_JOBS_SQL = """jobs AS (
  SELECT 'job-' || CAST(n_nationkey AS VARCHAR) AS job_doc_id,
    CASE n_nationkey % 6 WHEN 0 THEN 'nation-' || CAST(n_nationkey AS VARCHAR)
      WHEN 3 THEN '1' || CAST(n_nationkey AS VARCHAR)
      ELSE 'job-' || CAST(n_nationkey AS VARCHAR) END AS job_id,
    'customer' AS data_index,
    CASE WHEN n_nationkey = 7 THEN '' ELSE 'exports/' || lower(r_name) || '/' || lower(n_name) || '.csv' END
      AS remote_filename,
    CASE n_nationkey % 6
      WHEN 0 THEN CASE WHEN n_nationkey = 11 THEN '' ELSE 'c_custkey|name|segment|balance' END
      WHEN 1 THEN 'c_custkey|c_name' WHEN 3 THEN 'c_custkey' WHEN 5 THEN 'c_custkey' END AS columns,
    CASE n_nationkey % 6 WHEN 0 THEN 3 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 4 THEN 0 ELSE
      CASE n_nationkey % 6 WHEN 5 THEN 1 ELSE 0 END END AS n_paths,
    CASE n_nationkey % 6
      WHEN 2 THEN 'missing_fields' WHEN 3 THEN 'query_not_object' WHEN 4 THEN 'columns_not_strings'
      WHEN 5 THEN 'column_paths_not_strings'
      ELSE CASE WHEN n_nationkey = 7 THEN 'bad_remote_filename'
                WHEN n_nationkey = 11 THEN 'columns_empty' END END AS error
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""


def _job_validate_sql() -> str:
    return f"""WITH {_JOBS_SQL}
SELECT job_doc_id, job_id, data_index, remote_filename,
  CASE WHEN n_nationkey_cols_null THEN NULL ELSE columns END AS columns, n_paths, error
FROM (SELECT *, (error IN ('columns_not_strings') OR job_doc_id IS NULL) AS n_nationkey_cols_null FROM jobs)"""


def _job_lookup_sql() -> str:
    return f"""WITH {_JOBS_SQL},
ctl AS ({_DECODE_SQL})
SELECT ctl.partition, ctl."offset", ctl.job_doc_id, ctl.correlation_id, jobs.job_id,
  jobs.data_index, CASE WHEN jobs.job_doc_id IS NULL THEN 'not_found' ELSE jobs.error END AS error
FROM ctl LEFT JOIN jobs ON jobs.job_doc_id = ctl.job_doc_id
WHERE ctl.error IS NULL"""


def _delivery_plan_sql() -> str:
    safe = ("CASE WHEN regexp_full_match(job_id, '[A-Za-z0-9._-]+') AND job_id NOT IN ('.', '..') "
            "THEN job_id ELSE regexp_replace(job_id, '[^A-Za-z0-9._-]', '_', 'g') || '-' "
            "|| substr(md5(job_id), 1, 8) END")
    base = f"'{STAGING_ROOT}/' || {safe} || '/'"
    name = "regexp_extract(remote_filename, '([^/]*)/*$', 1)"
    return f"""WITH {_JOBS_SQL}
SELECT job_id, 1 AS seq, {base} || {name} AS local, remote_filename AS remote FROM jobs WHERE error IS NULL
UNION ALL
SELECT job_id, 2 AS seq, {base} || {name} || '.sha256' AS local, remote_filename || '.sha256' AS remote
FROM jobs WHERE error IS NULL"""


QUERIES = {
    "control_decode": (control_decode, lambda: _DECODE_SQL),
    "control_poison": (control_poison, lambda: f"""SELECT partition, "offset", error
FROM ({_DECODE_SQL}) WHERE error IS NOT NULL"""),
    "job_validate": (job_validate, _job_validate_sql),
    "job_lookup": (job_lookup, _job_lookup_sql),
    "delivery_plan": (delivery_plan_query, _delivery_plan_sql),
}
