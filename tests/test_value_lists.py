"""long value lists as tables."""

from __future__ import annotations

import re
from datetime import datetime

import duckdb
import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from docferry.operators import value_lists
from docferry.operators.predicates import QueryError
from docferry.operators.scan import count_matching, matching
from docferry.sources.tables import read_table

NOW = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def docs(spark):
    """A third of the rows share one id; some have none."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
        F.concat(F.lit("t"), F.col("id")).alias("s"))


def ks(df):
    return sorted((r["k"] is None, r["k"] or 0, r["s"]) for r in df.collect())


def expected(docs, keep):
    return sorted((r["k"] is None, r["k"] or 0, r["s"]) for r in docs.collect() if keep(r))


@pytest.mark.parametrize("max_bits", [1 << 26, 1])
def test_listed_and_unlisted(spark, docs, max_bits):
    listed = {7, 10, 2999, 5000, -4}
    values = spark.createDataFrame([(str(v),) for v in [*listed, 10]] + [(None,), ("x",), ("11.5",)], "v string")
    assert ks(value_lists.among(docs, "k", values, max_bits=max_bits)) == expected(docs, lambda r: r["k"] in listed)
    assert ks(value_lists.among(docs, "k", values, keep=False, max_bits=max_bits)) == \
        expected(docs, lambda r: r["k"] not in listed)


def test_empty_list_and_empty_table(spark, docs):
    none = spark.createDataFrame([(None,)], "v long")
    assert value_lists.among(docs, "k", none).count() == 0
    assert value_lists.among(docs, "k", none, keep=False).count() == 3000
    some = spark.createDataFrame([(7,)], "v long")
    assert value_lists.among(docs.limit(0), "k", some).count() == 0
    assert value_lists.among(docs.limit(0), "k", some, keep=False).count() == 0


def test_filter_holds_the_list_and_few_others(spark):
    values = spark.range(0, 40_000, 2).select(F.col("id").alias("value"))
    bits = 1 << 18
    words = value_lists.bloom_words(values, bits).scalar()
    got = spark.range(40_000).where(value_lists.may_hold(words, F.col("id"), bits)) \
        .groupBy((F.col("id") % 2).alias("odd")).count().collect()
    found = {r["odd"]: r["count"] for r in got}
    assert found[0] == 20_000
    assert found.get(1, 0) < 1_000


def test_long_literal_lists_are_no_part_of_the_plan(docs):
    many = [*range(1000, 13_000), "20", 8.0, 9.5, True, "x"]
    listed = {*range(1000, 13_000), 20, 8}
    q = {"bool": {"should": [{"prefix": {"s": "t1"}}], "must": [{"terms": {"k": many}}]}}
    df = matching(docs, q, now=NOW)
    assert "11999" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert ks(df) == expected(docs, lambda r: r["k"] in listed)
    q = {"bool": {"must_not": {"terms": {"s": [f"t{i}" for i in range(20, 11_000)]}}}}
    assert count_matching(docs, q, now=NOW) == 20
    assert count_matching(docs, {"ids": {"values": [f"t{i}" for i in range(2_500, 13_000)]}}, now=NOW, id_column="s") == 500


def test_same_as_literals(docs, monkeypatch):
    q = {"bool": {"filter": [{"terms": {"k": [7, "10", 2999, 1.5, "x"]}}], "must_not": [{"ids": {"values": ["t0", 10]}}]}}
    plain = ks(matching(docs, q, now=NOW, id_column="s"))
    monkeypatch.setattr(value_lists, "LITERALS", 1)
    assert ks(matching(docs, q, now=NOW, id_column="s")) == plain


def test_table_lists(spark, docs):
    tables = {"wanted": spark.createDataFrame([(7, "t3"), (20, "t20")], "k long, s string")}.__getitem__
    q = {"bool": {"filter": [{"terms": {"k": {"index": "wanted", "path": "k"}}}],
                  "must_not": [{"terms": {"s": {"index": "wanted", "path": "s"}}}]}}
    assert ks(matching(docs, q, now=NOW, tables=tables)) == \
        expected(docs, lambda r: r["k"] == 7 and r["s"] != "t3")
    with pytest.raises(QueryError):
        matching(docs, {"terms": {"k": {"index": "wanted", "path": "z"}}}, now=NOW, tables=tables)
    with pytest.raises(QueryError):  # only where all documents must satisfy it
        matching(docs, {"bool": {"should": [{"terms": {"k": {"index": "wanted", "path": "k"}}}]}}, now=NOW, tables=tables)


def test_range_reaches_the_scan_and_filter_comes_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = read_table(spark, SMALL, "lineitem")
        orders = read_table(spark, SMALL, "orders").filter("o_orderkey % 10 = 0").select("o_orderkey")
        df = value_lists.among(lines.select("l_orderkey", "l_linenumber"), "l_orderkey", orders)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_orderkey", plan)
        lines_side = plan[plan.index("Exchange hashpartitioning(l_orderkey"):]
        assert "getbit" in lines_side[:lines_side.index("FileScan")].lower()
        n = duckdb.sql(f"SELECT count(*) FROM '{SMALL}/lineitem.parquet' WHERE l_orderkey IN "
                       f"(SELECT o_orderkey FROM '{SMALL}/orders.parquet' WHERE o_orderkey % 10 = 0)").fetchall()[0][0]
        assert df.count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
