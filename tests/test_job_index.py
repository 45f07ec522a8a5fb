"""Jobs matched through the index against their queries as expressions."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docferry.operators import job_index
from docferry.operators.scan import JOB_TAG, tag_jobs

NOW = datetime(2024, 1, 31)
SCHEMA = "id long, name string, n int, big long, x double, ok boolean, t timestamp, d date, items array<int>"


def rows():
    rng = random.Random(4)
    some = lambda v: None if rng.random() < 0.15 else v
    return [(i, some(rng.choice(["a", "ab", "b", "", "é"])), some(rng.randrange(-3, 4)),
             some(rng.choice([2**53 + 1, 2**53, -5, 0, 7])), some(rng.choice([-1.5, 0.0, -0.0, 0.5, 2.0, 1e300])),
             some(rng.random() < 0.5), some(NOW - timedelta(hours=rng.randrange(96))), some((NOW - timedelta(days=i)).date()), [1])
            for i in range(60)]


def leaf(rng):
    kind = rng.randrange(9)
    if kind == 0:
        return {"term": {"name": rng.choice(["a", "ab", "zz", ""])}}
    if kind == 1:
        return {"terms": {"n": rng.choices([-3, -1, 0, 2, 3.0, 2.5, "x"], k=2)}}
    if kind == 2:
        return {"term": {"big": rng.choice([2**53 + 1, 2**53, 7, 10**30])}}
    if kind == 3:
        return {"term": {"x": rng.choice([0, 0.5, 2])}}
    if kind == 4:
        return {"range": {rng.choice(["n", "big", "x"]): {rng.choice(["gte", "gt"]): rng.choice([-2, 0, 0.5, 1.5]),
                                                          rng.choice(["lte", "lt"]): rng.choice([1, 2, 2**53, 2**53 + 1])}}}
    if kind == 5:
        return {"range": {"t": {rng.choice(["gte", "gt", "lte", "lt"]): rng.choice(["now-1d", "now-2d/d", "2024-01-29"])}}}
    if kind == 6:
        return {"exists": {"field": rng.choice(["name", "n", "t", "ok", "d"])}}
    if kind == 7:
        return {"prefix": {"name": rng.choice(["a", "", "é"])}}
    return rng.choice([{"match_all": {}}, {"term": {"ok": True}}, {"range": {"name": {"gt": "a", "lte": "b"}}}])


def query(rng, depth=0):
    if depth > 2 or rng.random() < 0.4:
        return leaf(rng)
    body = {}
    for key in ("must", "filter", "should", "must_not"):
        if rng.random() < 0.45:
            body[key] = [query(rng, depth + 1) for _ in range(rng.choice([1, 1, 2]))]
    return {"bool": body}


def build(spark, out_dir, jobs, df, name="index"):
    table = spark.createDataFrame([(j, json.dumps(q)) for j, q in jobs], "job_id string, query string")
    return job_index.build(table, df.schema, NOW, f"{out_dir}/{name}")


def test_random_queries(spark, out_dir):
    rng = random.Random(9)
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()
    jobs = [(f"j{i}", query(rng)) for i in range(120)]
    index = build(spark, out_dir, jobs, df)
    left_out = {r.job_id for r in index.unsupported.collect()}
    assert len(left_out) < 25
    got = sorted((r[JOB_TAG], r.id) for r in job_index.tag(df, index).select(JOB_TAG, "id").collect())
    kept = [j for j in jobs if j[0] not in left_out]
    want = []
    for at in range(0, len(kept), 20):
        _, tagged = tag_jobs(df, kept[at:at + 20], now=NOW)
        want += [(r[JOB_TAG], r.id) for r in tagged.select(JOB_TAG, "id").collect()]
    assert got == sorted(want) and len(got) > 500


def test_sums_of_random_queries(spark, out_dir):
    rng = random.Random(11)
    df = spark.createDataFrame(rows() + rows()[:9], SCHEMA).repartition(3).cache()
    jobs = [(f"j{i}", query(rng)) for i in range(120)]
    index = build(spark, out_dir, jobs, df)
    got = sorted(tuple(r) for r in job_index.tag(df, index, summary="id").select(JOB_TAG, "n", "first", "last").collect())
    want = job_index.tag(df, index).groupBy(JOB_TAG).agg(F.count(F.lit(1)), F.min("id"), F.max("id"))
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) > 60
    none = build(spark, out_dir, [], df, "no_sums")
    assert job_index.tag(df, none, summary="id").count() == job_index.tag(df.limit(0), index, summary="id").count() == 0


def test_rows_meet_only_jobs_whose_value_and_range_hold(spark, out_dir):
    df = spark.range(2000).selectExpr("id", "cast(id % 2 as int) n", "id / 2e0 x", "concat('name', id) name")
    jobs = [(f"r{i}", {"bool": {"must": [{"term": {"n": i % 2}}, {"range": {"x": {"gte": i, "lt": i + 1}}}]}}) for i in range(300)]
    jobs += [(f"p{i}", {"bool": {"must": [{"term": {"n": i % 2}}, {"prefix": {"name": f"name{i}"}}]}}) for i in range(100, 200)]
    jobs += [(f"s{i}", {"bool": {"should": [{"term": {"id": i}}, {"range": {"x": {"gte": 0, "lt": 900}}}]}}) for i in range(300)]
    index = build(spark, out_dir, jobs, df)
    assert index.entries.filter("job_id not like 's%' and size(tests) > 0").count() == 0
    got = {r[JOB_TAG]: (r.n, r.first, r.last) for r in job_index.tag(df, index, summary="id").collect()}
    assert got["r7"] == (1, 15, 15) and got["p150"] == (6, 150, 1508) and got["s5"] == (1800, 0, 1799) and len(got) == 700
    # Rows are summed up by their keys before they meet jobs: 700 sums, not 540,000 rows and jobs.
    plan = job_index.tag(df, index, summary="id")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):]
    assert "count(1)" in below and "min(" in below


@pytest.mark.parametrize("bad", [
    {"term": {"items": 1}}, {"term": {"items.x": 1}}, {"nope": {}}, {"range": {"n": {}}}, [], "x",
    {"bool": {"should": [{"match_all": {}}], "minimum_should_match": 2}}, {"range": {"d": {"gte": "2024-01-01"}}},
    {"bool": {"must": [{"bool": {"should": [{"term": {"n": i}} for i in range(9)]}}] * 2}}])
def test_queries_left_to_expressions(spark, out_dir, bad):
    df = spark.createDataFrame(rows(), SCHEMA)
    index = build(spark, out_dir, [("bad", bad), ("good", {"term": {"n": 1}})], df)
    assert [r.job_id for r in index.unsupported.collect()] == ["bad"]
    assert {r[JOB_TAG] for r in job_index.tag(df, index).select(JOB_TAG).collect()} <= {"good"}


def test_no_jobs_and_no_rows(spark, out_dir):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert job_index.tag(df, build(spark, out_dir, [], df, "none")).count() == 0
    index = build(spark, out_dir, [("all", {"match_all": {}})], df)
    assert job_index.tag(df, index).count() == 60 and job_index.tag(df.limit(0), index).count() == 0


def test_plan_does_not_grow_with_the_jobs(spark, out_dir):
    df = spark.createDataFrame(rows(), SCHEMA)

    def size(n):
        jobs = [(f"j{i}", {"bool": {"must": [{"term": {"n": i}}, {"range": {"x": {"gte": i, "lt": i + 5}}}]}})
                for i in range(n)]
        jobs += [(f"r{i}", {"range": {"x": {"gte": i, "lt": i + 5}}}) for i in range(64)]
        tagged = job_index.tag(df, build(spark, out_dir, jobs, df, f"of{n}"))
        return len(tagged._jdf.queryExecution().optimizedPlan().toString())

    assert abs(size(2000) - size(20)) < 400


def test_exports_beyond_the_jobs_of_a_scan_use_the_index(spark, out_dir, monkeypatch):
    from helpers import SMALL

    from docferry.operators.jobs import JobSpec
    from docferry.plans.job_run import RunOptions, run_export, run_exports_one_scan
    from docferry.sources.tables import driver_catalog

    cat = driver_catalog(spark, SMALL)
    jobs = [JobSpec(job_id=f"n{i}", data_index="customer", query=q, columns=["c_custkey", "c_name"],
                    remote_filename=f"n{i}.csv")
            for i, q in enumerate([{"term": {"c_nationkey": 3}}, {"range": {"c_acctbal": {"gte": 100, "lt": 2000}}},
                                   {"term": {"c_nationkey": 99}}, {"ids": {"values": []}}][:3])]
    many = run_exports_one_scan(spark, jobs, cat, now=NOW, options=RunOptions(
        staging_root=f"{out_dir}/many", rows_per_part=7, max_jobs_per_scan=2))
    for j in jobs:
        one = run_export(spark, j, cat, now=NOW, options=RunOptions(staging_root=f"{out_dir}/one", rows_per_part=7))
        assert (many[j.job_id].row_count, many[j.job_id].n_parts) == (one.row_count, one.n_parts)

        def lines(path):
            return sorted(r.value for r in spark.read.text(path).filter(F.col("value") != "c_custkey,c_name").collect())

        assert lines(many[j.job_id].path) == lines(one.path)
