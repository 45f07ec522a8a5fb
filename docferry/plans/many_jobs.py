"""Registered queries: one job for each customer, all matched in one scan."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.operators import job_index
from docferry.operators.scan import JOB_TAG
from docferry.session import checkpoint_dir
from docferry.sources.tables import read_table

NOW = datetime(2024, 1, 31)


def customer_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, query): for each customer a query of one of five shapes."""
    c = read_table(spark, sf_dir, "customer")
    key, bal = F.col("c_custkey").cast("string"), "round(c_acctbal)"
    low, high = F.expr(f"cast(cast({bal} - 50 as bigint) as string)"), F.expr(f"cast(cast({bal} + 50 as bigint) as string)")
    nation = F.col("c_nationkey").cast("string")
    other = F.expr("cast((c_nationkey + 7) % 25 as string)")
    segment = F.concat(F.lit('{"term": {"c_mktsegment": "'), F.col("c_mktsegment"), F.lit('"}}'))
    near = F.concat(F.lit('{"range": {"c_acctbal": {"gte": '), low, F.lit(', "lt": '), high, F.lit("}}}"))
    query = (
        F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit('{"bool": {"must": ['), segment, F.lit(", "), near, F.lit("]}}")))
        .when(F.col("c_custkey") % 5 == 1, F.concat(
            F.lit('{"bool": {"filter": [{"terms": {"c_nationkey": ['), nation, F.lit(", "), other, F.lit("]}}, "), near,
            F.lit("]}}")))
        .when(F.col("c_custkey") % 5 == 2, F.concat(
            F.lit('{"range": {"c_custkey": {"gt": '), key, F.lit(', "lte": '),
            (F.col("c_custkey") + 3).cast("string"), F.lit("}}}")))
        .when(F.col("c_custkey") % 5 == 3, F.concat(
            F.lit('{"bool": {"should": [{"term": {"c_custkey": '), key, F.lit("}}, "), near, F.lit('], "must_not": ['),
            segment, F.lit("]}}")))
        .otherwise(F.concat(
            F.lit('{"bool": {"must": [{"term": {"c_nationkey": '), nation,
            F.lit('}}, {"exists": {"field": "c_acctbal"}}, {"prefix": {"c_name": "'),
            F.expr("substring(c_name, 1, length(c_name) - 1)"), F.lit('"}}]}}'))))
    return c.select(F.concat(F.lit("customer-"), key).alias("job_id"), query.alias("query"))


def many_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many customers each of the jobs selects."""
    customers = read_table(spark, sf_dir, "customer")
    path = f"{checkpoint_dir(spark).rstrip('/')}/jobs/index-{uuid.uuid4().hex}"
    jobs = customer_jobs(spark, sf_dir)
    index = job_index.build(jobs, customers.schema, NOW, path)
    counts = job_index.tag(customers, index, summary="c_custkey").withColumnRenamed(JOB_TAG, "job_id")
    return jobs.select("job_id").join(counts, "job_id", "left").select(
        "job_id", F.coalesce("n", F.lit(0)).alias("source_count"), "first", "last")


QUERIES = {
    "many_jobs": (many_jobs, lambda: """WITH j AS (
  SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment AS s, CAST(round(c_acctbal) - 50 AS BIGINT) AS lo,
    CAST(round(c_acctbal) + 50 AS BIGINT) AS hi, left(c_name, length(c_name) - 1) AS p FROM customer)
SELECT 'customer-' || CAST(j.k AS VARCHAR) AS job_id, count(c.c_custkey) AS source_count,
  min(c.c_custkey) AS first, max(c.c_custkey) AS last
FROM j LEFT JOIN customer c ON CASE j.k % 5
  WHEN 0 THEN c.c_mktsegment = j.s AND c.c_acctbal >= j.lo AND c.c_acctbal < j.hi
  WHEN 1 THEN c.c_nationkey IN (j.n, (j.n + 7) % 25) AND c.c_acctbal >= j.lo AND c.c_acctbal < j.hi
  WHEN 2 THEN c.c_custkey > j.k AND c.c_custkey <= j.k + 3
  WHEN 3 THEN (c.c_custkey = j.k OR c.c_acctbal >= j.lo AND c.c_acctbal < j.hi) AND c.c_mktsegment <> j.s
  ELSE c.c_nationkey = j.n AND starts_with(c.c_name, j.p) END
GROUP BY j.k"""),
}
