"""Registered query: expected counts of jobs from file statistics (A1)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.operators.statistics import count_by_statistics
from docferry.session import checkpoint_dir
from docferry.sources.tables import read_table

NOW = datetime(2024, 1, 31)

# name -> (query, its SQL)
JOBS = {
    "match_all": ({"match_all": {}}, "true"),
    "exists": ({"exists": {"field": "o_custkey"}}, "o_custkey IS NOT NULL"),
    "days": ({"range": {"day": {"gte": "1995-03-15", "lt": "1997-07-01"}}},
             "day >= DATE '1995-03-15' AND day < DATE '1997-07-01'"),
    "years": ({"bool": {"filter": [{"range": {"year": {"gt": 1994}}}, {"exists": {"field": "day"}}]}},
              "year > 1994 AND day IS NOT NULL"),
    "keys": ({"bool": {"must": [{"range": {"o_orderkey": {"gte": 0}}}, {"range": {"day": {"gte": "1996-01-01"}}}]}},
             "o_orderkey >= 0 AND day >= DATE '1996-01-01'"),
    "status": ({"bool": {"must": [{"term": {"o_orderstatus": "F"}}, {"range": {"day": {"lt": "1994-02-01"}}}]}},
               "o_orderstatus = 'F' AND day < DATE '1994-02-01'"),
    "nobody": ({"term": {"o_custkey": -1}}, "o_custkey = -1"),
}


def count_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: how many orders each job selects from orders kept by year; only
    years that a job selects in part are scanned."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/statistics/orders-{uuid.uuid4().hex}"
    (read_table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")).withColumn("year", F.year("day"))
     .write.partitionBy("year").parquet(path))
    out = None
    for name, (query, _) in JOBS.items():
        n = count_by_statistics(spark, path, query, now=NOW, partitions=["year"]).select(
            F.lit(name).alias("job_id"), "source_count", "from_statistics")
        out = n if out is None else out.unionByName(n)
    return out


def _sql() -> str:
    # A year counts from statistics if all its orders match, without text clauses.
    whole = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS job_id, year, count(*) FILTER (WHERE {sql}) AS n, "
        + ("0" if name == "status" else f"CASE WHEN bool_and({sql}) THEN count(*) ELSE 0 END") + " AS known FROM o GROUP BY year"
        for name, (_, sql) in JOBS.items())
    return f"""WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS year FROM orders),
w AS ({whole})
SELECT job_id, CAST(sum(n) AS BIGINT) AS source_count, CAST(sum(known) AS BIGINT) AS from_statistics FROM w GROUP BY job_id"""


QUERIES = {"count_statistics": (count_statistics, _sql)}
