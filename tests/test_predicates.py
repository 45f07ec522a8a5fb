"""Job queries."""

from __future__ import annotations

from datetime import datetime

import pytest

from docferry.operators.predicates import QueryError, resolve_date_math
from docferry.operators.scan import count_matching, count_per_job, matching

NOW = datetime(2024, 1, 31, 0, 0, 0)


@pytest.fixture(scope="module")
def docs(spark):
    data = [
        (1, "a", 10, datetime(2024, 1, 30, 6), ["x", "y"], ("n1",)),
        (2, "b", 20, datetime(2024, 1, 29, 6), [], ("n2",)),
        (3, None, None, None, None, None),
        (4, "ab", 30, datetime(2024, 1, 1), ["y"], (None,)),
    ]
    return spark.createDataFrame(
        data, "id long, s string, n int, ts timestamp_ntz, tags array<string>, u struct<name: string>")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def q(docs, query):
    return ids(matching(docs, query, now=NOW, id_column="id"))


def test_match_all_and_count(docs):
    assert q(docs, {"match_all": {}}) == [1, 2, 3, 4]
    assert count_matching(docs, {"match_all": {}}, now=NOW) == 4


def test_range_and_date_math(docs):
    assert q(docs, {"range": {"n": {"gte": 20}}}) == [2, 4]
    assert q(docs, {"range": {"n": {"gt": 10, "lt": 30}}}) == [2]
    assert q(docs, {"range": {"ts": {"gte": "now-1d"}}}) == [1]
    assert q(docs, {"range": {"ts": {"gte": "now-2d/d"}}}) == [1, 2]
    assert q(docs, {"range": {"ts": {"lte": "2024-01-01"}}}) == [4]


def test_term_terms_prefix_exists_ids(docs):
    assert q(docs, {"term": {"s": "a"}}) == [1]
    assert q(docs, {"term": {"tags": "y"}}) == [1, 4]
    assert q(docs, {"terms": {"s": ["a", "b"]}}) == [1, 2]
    assert q(docs, {"prefix": {"s": "a"}}) == [1, 4]
    assert q(docs, {"exists": {"field": "u.name"}}) == [1, 2]
    assert q(docs, {"exists": {"field": "tags"}}) == [1, 4]
    assert q(docs, {"ids": {"values": ["2", 3]}}) == [2, 3]
    assert q(docs, {"term": {"u.name": {"value": "n2"}}}) == [2]


def test_missing_field_semantics(docs):
    # Positive clause on a missing field never matches; its negation always does.
    assert q(docs, {"term": {"nope": 1}}) == []
    assert q(docs, {"bool": {"must_not": [{"term": {"nope": 1}}]}}) == [1, 2, 3, 4]
    # Null values: NOT(s = 'a') keeps the row whose s is null.
    assert q(docs, {"bool": {"must_not": [{"term": {"s": "a"}}]}}) == [2, 3, 4]


def test_bool_should_rules(docs):
    assert q(docs, {"bool": {"should": [{"term": {"s": "a"}}, {"term": {"s": "b"}}]}}) == [1, 2]
    assert q(docs, {"bool": {"filter": [{"range": {"n": {"gte": 0}}}],
                             "should": [{"term": {"s": "zzz"}}]}}) == [1, 2, 4]
    assert q(docs, {"bool": {"should": [{"term": {"s": "a"}}, {"prefix": {"s": "a"}}],
                             "minimum_should_match": 2}}) == [1]


def test_errors_at_plan_time(docs):
    for bad in [{}, ["not", "a", "dict"], {"nope": {}}, {"range": {"n": {"near": 1}}},
                {"match_all": {}, "term": {"s": "a"}}, {"terms": {"s": "a"}}]:
        with pytest.raises(QueryError):
            matching(docs, bad, now=NOW)


def test_date_math_units():
    now = datetime(2024, 3, 31, 15, 30, 10)
    assert resolve_date_math("now-1d", now) == datetime(2024, 3, 30, 15, 30, 10)
    assert resolve_date_math("now-1M", now) == datetime(2024, 2, 29, 15, 30, 10)
    assert resolve_date_math("now/d", now) == datetime(2024, 3, 31)
    assert resolve_date_math("now/d", now, round_up=True) == datetime(2024, 3, 31, 23, 59, 59, 999000)
    assert resolve_date_math("2024-01-01||+1y-2h", now) == datetime(2024, 12, 31, 22)
    with pytest.raises(QueryError):
        resolve_date_math("now-1q", now)


def test_count_per_job_one_scan(docs):
    jobs = [("j-a", {"prefix": {"s": "a"}}), ("j-all", {"match_all": {}}), ("j-none", {"term": {"s": "q"}})]
    got = {r.job_id: r.source_count for r in count_per_job(docs, jobs, now=NOW).collect()}
    assert got == {"j-a": 2, "j-all": 4, "j-none": 0}


def test_scoring_options_are_ignored(docs):
    assert q(docs, {"terms": {"s": ["a", "b"], "boost": 2.0}}) == [1, 2]
    assert q(docs, {"term": {"s": {"value": "a", "boost": 1.5}}, }) == [1]
    assert q(docs, {"bool": {"must": [{"match_all": {"boost": 1}}], "_name": "x"}}) == [1, 2, 3, 4]


def test_query_paths_fan_out_over_lists_of_objects(spark):
    data = [(1, [("a", 5), ("b", 50)]), (2, [("c", 7)]), (3, []), (4, None), (5, [(None, None)])]
    df = spark.createDataFrame(data, "id int, items array<struct<sku: string, qty: int>>")
    assert q(df, {"term": {"items.sku": "b"}}) == [1]
    assert q(df, {"terms": {"items.sku": ["a", "c"]}}) == [1, 2]
    assert q(df, {"range": {"items.qty": {"gte": 6, "lt": 40}}}) == [2]
    assert q(df, {"prefix": {"items.sku": "c"}}) == [2]
    assert q(df, {"exists": {"field": "items.sku"}}) == [1, 2]
    assert q(df, {"bool": {"must_not": [{"term": {"items.sku": "a"}}]}}) == [2, 3, 4, 5]
    # Projection keeps the path language: no fan-out there.
    from docferry.operators.projection import project
    assert project(df, ["x"], {"x": "items.sku"}).distinct().collect()[0][0] == ""


def test_relational_child_fan_out(spark):
    from pyspark.sql import functions as F

    from docferry.sources.documents import Children, DocumentView

    root = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    kids = spark.createDataFrame([(1, "a", 5), (1, "b", 50), (2, "c", 7)], "p int, sku string, q int")
    view = DocumentView(root, "p", children={"items": Children(kids, "p", ("sku",), F.struct("sku", "q"))})

    def hits(query):
        return sorted(r.p for r in matching(view, query, now=NOW).collect())

    assert hits({"term": {"items.sku": "b"}}) == [1]
    assert hits({"range": {"items.q": {"gte": 6, "lt": 40}}}) == [2]
    assert hits({"exists": {"field": "items.sku"}}) == [1, 2]
    assert hits({"bool": {"must_not": [{"term": {"items.sku": "a"}}]}}) == [2, 3]
    assert hits({"bool": {"must": [{"prefix": {"items.sku": "c"}}, {"range": {"p": {"gte": 2}}}]}}) == [2]
    jobs = [("j1", {"term": {"items.sku": "b"}}), ("j2", {"exists": {"field": "items.q"}})]
    got = {r.job_id: r.source_count for r in count_per_job(view, jobs, now=NOW).collect()}
    assert got == {"j1": 1, "j2": 2}


def test_fan_out_same_alone_and_in_one_scan(spark):
    from helpers import SMALL
    from docferry.sources.documents import order_documents

    view = order_documents(spark, SMALL)
    q = {"bool": {"must": [{"range": {"items.qty": {"gte": 49}}}],
                  "must_not": [{"term": {"items.ship.flag": "R"}}]}}
    alone = matching(view, q, now=NOW).count()
    together = {r.job_id: r.source_count for r in
                count_per_job(order_documents(spark, SMALL), [("q", q), ("all", {"match_all": {}})],
                              now=NOW).collect()}
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    big = {r[0] for r in li.where("l_quantity >= 49").select("l_orderkey").distinct().collect()}
    returned = {r[0] for r in li.where("l_returnflag = 'R'").select("l_orderkey").distinct().collect()}
    assert alone == together["q"] == len(big - returned) > 0


def test_ids_above_two_to_the_53(spark):
    big = 9007199254740992
    docs = spark.createDataFrame([(big,), (big + 1,)], "id long")
    assert q(docs, {"term": {"id": big + 1}}) == [big + 1]
    assert q(docs, {"term": {"id": str(big + 1)}}) == [big + 1]
    assert q(docs, {"ids": {"values": [str(big + 1)]}}) == [big + 1]


def test_zoned_dates_do_not_depend_on_the_machine(monkeypatch):
    import time

    for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        assert resolve_date_math("2024-01-10T00:00:00Z", NOW) == datetime(2024, 1, 10)
        assert resolve_date_math("2024-01-10T00:00:00+02:00", NOW) == datetime(2024, 1, 9, 22)
    monkeypatch.undo()
    time.tzset()


def test_missing_time_parts():
    assert resolve_date_math("2024-01-10", NOW, round_up=True) == datetime(2024, 1, 10, 23, 59, 59, 999999)
    assert resolve_date_math("2024-01", NOW, round_up=True) == datetime(2024, 1, 1, 23, 59, 59, 999999)
    assert resolve_date_math("2024-01-10T05", NOW) == datetime(2024, 1, 10, 5)
    assert resolve_date_math("2024", NOW) == datetime(2024, 1, 1)


@pytest.mark.parametrize("spec", [{"gte": "2024-01-10", "format": "dd/MM/yyyy"}, {"gte": "x", "format": "epoch_second"},
                                  {"gte": "2024-01-10", "time_zone": "Nowhere/Land"}])
def test_options_not_understood_are_errors(docs, spec):
    with pytest.raises(QueryError):
        q(docs, {"range": {"ts": spec}})
    with pytest.raises(QueryError):
        q(docs, {"range": {"n": {"gte": 1, "time_zone": "+01:00"}}})


def test_schemaless_lists(spark):
    from docferry.sources.documents import json_string_documents

    rows = [(1, '{"tags":["x","y"],"items":[{"sku":"s1","n":[1,5]},{"sku":7}]}'), (2, '{"tags":"x","items":{"sku":"s1"}}'),
            (3, '{"tags":[],"items":[]}'), (4, '{"tags":null,"id":9007199254740993}'), (5, 'broken')]
    view = json_string_documents(spark.createDataFrame(rows, "id long, j string"), "j", id_column="id")

    def found(query):
        return sorted(r["id"] for r in matching(view, query, now=NOW).collect())

    assert found({"term": {"tags": "x"}}) == [1, 2]
    assert found({"terms": {"tags": ["y", 3]}}) == [1]
    assert found({"terms": {"items.sku": [7, "none"]}}) == [1]
    assert found({"prefix": {"items.sku": "s"}}) == [1, 2]
    assert found({"exists": {"field": "tags"}}) == [1, 2]
    assert found({"exists": {"field": "items.sku"}}) == [1, 2]
    assert found({"range": {"items.n": {"gt": 4}}}) == [1]
    assert found({"range": {"items.n": {"gt": 1, "lt": 5}}}) == []
    assert found({"term": {"items[0].sku": "s1"}}) == [1]
    assert found({"term": {"id": 9007199254740992}}) == []
    assert found({"bool": {"must_not": [{"exists": {"field": "tags"}}]}}) == [3, 4, 5]
