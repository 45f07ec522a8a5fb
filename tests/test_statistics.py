"""A1: counts from footers against the scan's."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from docferry.operators.predicates import QueryError
from docferry.operators.scan import count_matching
from docferry.operators.statistics import _footers_only, count_by_statistics, judged_partitions

NOW = datetime(2024, 1, 31)
SCHEMA = "p int, q string, n long, x double, d date, s string"


def leaf(rng):
    return rng.choice([
        {"match_all": {}},
        {"exists": {"field": rng.choice(["n", "x", "d", "s", "p", "q", "gone"])}},
        {"range": {"n": {rng.choice(["gte", "gt"]): rng.choice([-1, 0, 5, 9.5, 10, 31]),
                         rng.choice(["lte", "lt"]): rng.choice([4, 10, 19.5, 29, 2**65])}}},
        {"range": {"n": {"gt": rng.randrange(32)}}},
        {"range": {"d": {rng.choice(["gte", "gt", "lte", "lt"]): rng.choice(["2024-01-05", "now-20d/d", "2024-01-10||/M"])}}},
        {"range": {"x": {"gte": rng.choice([-5, 1.5])}}},
        {"range": {"p": {rng.choice(["gte", "lt"]): rng.randrange(4)}}},
        {"term": {"n": rng.choice([3, 99, 7.5, "x", "7"])}},
        {"term": {"p": rng.choice([0, 2, 9])}},
        {"term": {"q": "a"}}, {"term": {"s": "b"}}, {"prefix": {"s": "a"}}])


def query(rng):
    if rng.random() < 0.3:
        return leaf(rng)
    return {"bool": {k: [leaf(rng) for _ in range(rng.choice([1, 2]))]
                     for k in ("must", "filter", "should", "must_not") if rng.random() < (0.6 if k in ("must", "filter") else 0.2)}}


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(7)
    some = lambda v: None if rng.random() < 0.05 else v
    rows = [(None if p == 3 else p, q, some(10 * p + rng.randrange(10)) if p else 10 * p + rng.randrange(10),
             some(rng.choice([1.0, float("nan"), 2.5])), date(2024, 1, 1) + timedelta(days=5 * p + rng.randrange(5)),
             some(rng.choice(["a", "b"]))) for p in range(4) for q in ("a", "b") for _ in range(25)]
    path = str(tmp_path_factory.mktemp("statistics") / "table")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.partitionBy("p", "q").parquet(path)
    return path


@pytest.mark.parametrize("seed", range(25))
def test_counts_equal_the_scan(spark, table, seed):
    q = query(random.Random(seed))
    got = count_by_statistics(spark, table, q, now=NOW, partitions=["p", "q"]).first()
    assert got.source_count == count_matching(spark.read.parquet(table), q, now=NOW), q
    assert got.from_statistics <= got.source_count


def test_whole_partitions_are_not_read(spark, table):
    q = {"range": {"d": {"gte": "2024-01-06"}}}
    with _footers_only(spark):
        judged = judged_partitions(spark, table, q, now=NOW, partitions=["p", "q"])
        plan = judged._jdf.queryExecution().executedPlan().toString()
        verdicts = {(r.p, r.q): r.verdict for r in judged.collect()}
    assert "PushedAggregation: [COUNT(*)" in plan
    assert verdicts == {(None, "a"): "some", (None, "b"): "some", (0, "a"): "none", (0, "b"): "none",
                        (1, "a"): "all", (1, "b"): "all", (2, "a"): "all", (2, "b"): "all"}
    got = count_by_statistics(spark, table, q, now=NOW, partitions=["p", "q"]).first()
    assert tuple(got) == (150, 100)


def test_odd_tables(spark, out_dir):
    plain, empty, nulls = (f"{out_dir}/{x}" for x in ("plain", "empty", "nulls"))
    frame = spark.createDataFrame([(i, None) for i in range(10)], "n long, m long")
    frame.write.parquet(plain)
    frame.where("n < 0").write.parquet(empty)
    frame.select("m").write.parquet(nulls)
    count = lambda path, q: tuple(count_by_statistics(spark, path, q, now=NOW).first())
    assert count(plain, {"range": {"n": {"gte": 0}}}) == (10, 10)
    assert count(plain, {"range": {"n": {"gt": 0}}}) == (9, 0)
    assert count(plain, {"exists": {"field": "m"}}) == (0, 0)
    assert count(empty, {"match_all": {}}) == (0, 0)
    # Nulls only: no least value in the footers.
    assert count(nulls, {"range": {"m": {"gte": 0}}}) == (0, 0)
    with pytest.raises(QueryError):
        count(plain, {"fuzzy": {"n": 1}})
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
