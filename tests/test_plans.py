"""Plan shape of the registered queries: no pair-producing joins, filters at the scan."""

from __future__ import annotations

import re

import pytest

from docferry.plans import registry

from helpers import SMALL

QUERIES = registry.queries()
BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_producing_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for node in BAD_NODES:
        assert node not in plan, f"{name} plans a {node}"


@pytest.mark.parametrize("name", ["filter_range", "filter_term", "filter_bool",
                                  "filter_range_date_math", "export_filtered_orders",
                                  "filter_missing_field"])
def test_job_filter_reaches_the_scan(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert re.search(r"PushedFilters: \[[A-Za-z]", plan), plan


def test_flagship_prunes_columns(spark):
    plan = _plan(QUERIES["export_order_docs"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


def test_alternatives_reach_the_scan(spark):
    plan = _plan(QUERIES["filter_bool"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*Or\(", plan), plan


@pytest.mark.parametrize("name", ["path_mixed", "path_list_index", "path_conversation_turns"])
def test_list_index_gathers_nothing(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "collect_list" not in plan


def test_large_rank_is_limited_before_the_shuffle(spark):
    from docferry.operators.projection import project
    from docferry.sources.documents import order_documents

    plan = _plan(project(order_documents(spark, SMALL), ["order_id", "s"], {"s": "items[1200].sku"}))
    assert "WindowGroupLimit" in plan


def test_one_aggregate_for_a_relation(spark):
    from datetime import datetime

    from docferry.operators.scan import matching
    from docferry.sources.documents import order_documents

    q = {"bool": {"should": [{"term": {"items.sku": 1}}, {"range": {"items.qty": {"gt": 49}}},
                             {"exists": {"field": "items.sku"}}]}}
    plan = _plan(matching(order_documents(spark, SMALL), q, now=datetime(2024, 1, 31)))
    assert plan.count("FileScan parquet") == 2


def test_job_table_is_joined(spark):
    plan = _plan(QUERIES["multi_job_export"](spark, SMALL))
    assert "Join" in plan and "LocalTableScan" not in plan
