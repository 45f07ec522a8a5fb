"""Registered queries: job filters (F1-F7) and counts (A1)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.operators.projection import project
from docferry.operators.scan import bind_job, count_per_job, matching
from docferry.plans.sqltext import ITEMS_CTE, txt
from docferry.sources.documents import event_documents, json_string_documents, order_documents
from docferry.sources.tables import read_table

# The job-run clock of the test jobs (events span 2024-01-01..30).
NOW = datetime(2024, 1, 31, 0, 0, 0)

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_KEYS_SQL = ", ".join(LINE_KEYS)


def _lineitem_where(spark, sf_dir, query) -> DataFrame:
    return matching(read_table(spark, sf_dir, "lineitem"), query, now=NOW).select(*LINE_KEYS)


def filter_match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_where(spark, sf_dir, {"match_all": {}})


def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {"bool": {"filter": [
        {"range": {"l_quantity": {"gte": 10, "lt": 30}}},
        {"range": {"l_shipdate": {"gt": "1996-03-01", "lte": "1998-06-30T12:00:00"}}},
    ]}}
    return _lineitem_where(spark, sf_dir, q)


BIG = 9_007_199_254_740_992  # 2^53: neighbours above it are one float


def filter_big_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids above 2^53, as typed and as schemaless values."""
    docs = read_table(spark, sf_dir, "documents").select((F.col("doc_id") + BIG).alias("id"), "lang")
    ids = [BIG + 1, BIG + 2, str(BIG + 5), BIG + 11]
    typed = matching(docs, {"bool": {"should": [{"terms": {"id": ids}}, {"ids": {"values": [str(BIG + 7)]}},
                                                {"range": {"id": {"gt": BIG + 20, "lte": BIG + 23}}}]}},
                     now=NOW, id_column="id").select("id", F.lit("typed").alias("kind"))
    free = json_string_documents(docs.select(F.to_json(F.struct("id", "lang")).alias("j")), "j")
    loose = matching(free, {"bool": {"should": [{"term": {"id": BIG + 1}}, {"terms": {"id": [BIG + 3, "en"]}},
                                                {"range": {"id": {"gt": BIG + 20, "lte": BIG + 23}}}]}}, now=NOW)
    return typed.unionByName(loose.select(F.try_variant_get(F.col(free.variant_root), "$.id", "bigint").alias("id"),
                                          F.lit("loose").alias("kind")))


def filter_value_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines of the parts in one table, but not of the orders in another."""
    lists = {"large_parts": read_table(spark, sf_dir, "part").filter("p_size > 25"),
             "urgent": read_table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")}
    q = {"bool": {"filter": [{"terms": {"l_partkey": {"index": "large_parts", "path": "p_partkey"}}},
                             {"range": {"l_quantity": {"lt": 20}}}],
                  "must_not": [{"terms": {"l_orderkey": {"index": "urgent", "path": "o_orderkey"}}}]}}
    return matching(read_table(spark, sf_dir, "lineitem"), q, now=NOW, tables=lists.__getitem__).select(*LINE_KEYS)


def filter_date_only_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds without time: gt and lte mean the end of that day."""
    view = event_documents(spark, sf_dir)
    out = None
    for name, spec in (("gt", {"gt": "2024-01-10"}), ("lte", {"lte": "2024-01-10"}), ("gte", {"gte": "2024-01-10"}),
                       ("lt", {"lt": "2024-01-10"}), ("hour", {"gt": "2024-01-10T05", "lte": "2024-01-10T06:30"})):
        rows = matching(view, {"range": {"ts": spec}}, now=NOW).select(F.lit(name).alias("bound"), "event_id")
        out = rows if out is None else out.unionByName(rows)
    return out


def filter_zoned_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds with an offset, a time_zone, and in seconds since 1970."""
    view = event_documents(spark, sf_dir)
    out = None
    for name, spec in (("zulu", {"gte": "2024-01-10T00:00:00Z", "lt": "2024-01-11T00:00:00Z"}),
                       ("offset", {"gte": "2024-01-10T00:00:00+05:00", "lt": "2024-01-11T00:00:00Z"}),
                       ("zone", {"gte": "2024-01-10T00:00:00", "lte": "2024-01-10", "time_zone": "+05:00"}),
                       ("named", {"gte": "2024-01-10", "lt": "2024-01-11", "time_zone": "America/New_York"}),
                       ("epoch", {"gte": 1704844800, "lt": "1704931200", "format": "epoch_second"}),
                       ("round", {"gte": "now-5d/d", "lt": "now-4d/d", "time_zone": "-03:00"})):
        rows = matching(view, {"range": {"ts": spec}}, now=NOW).select(F.lit(name).alias("bound"), "event_id")
        out = rows if out is None else out.unionByName(rows)
    return out


def _bounds_sql(cases: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS bound, event_id FROM events WHERE {c}" for n, c in cases.items())


def conversation_json(spark: SparkSession, sf_dir: str):
    """Schemaless documents, one for each conversation: roles (a list of text),
    turns (a list of objects)."""
    turns = read_table(spark, sf_dir, "conversations")
    docs = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    text = F.to_json(F.struct("conv_id", F.col("turns.role").alias("roles"), "turns"))
    return json_string_documents(docs.select(text.alias("j")), "j")


def filter_variant_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists and lists of objects inside schemaless documents: any value may
    match."""
    view = conversation_json(spark, sf_dir)
    out = None
    for name, q in (("value", {"term": {"roles": "system"}}), ("object", {"term": {"turns.role": "system"}}),
                    ("prefix", {"prefix": {"turns.role": "sys"}}), ("range", {"range": {"turns.turn": {"gte": 3}}}),
                    ("terms", {"terms": {"roles": ["tool", "system", 4]}}),
                    ("none", {"bool": {"must_not": [{"exists": {"field": "turns.role"}}]}})):
        rows = matching(view, q, now=NOW).select(
            F.lit(name).alias("clause"), F.try_variant_get(F.col(view.variant_root), "$.conv_id", "bigint").alias("conv_id"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _variant_lists_sql() -> str:
    cases = {"value": "bool_or(role = 'system')", "object": "bool_or(role = 'system')",
             "prefix": "bool_or(starts_with(role, 'sys'))", "range": "bool_or(turn >= 3)",
             "terms": "bool_or(role IN ('tool', 'system'))", "none": "NOT bool_or(role IS NOT NULL)"}
    return " UNION ALL ".join(f"SELECT '{n}' AS clause, conv_id FROM conversations GROUP BY conv_id HAVING {c}"
                              for n, c in cases.items())


def filter_range_date_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {"range": {"ts": {"gte": "now-1d"}}}
    return matching(event_documents(spark, sf_dir), q, now=NOW).select("event_id", "event_type")


def filter_date_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # gte rounds down to the start of the day, lte up to its last millisecond.
    q = {"range": {"ts": {"gte": "now-5d/d", "lte": "now-2d/d"}}}
    return matching(event_documents(spark, sf_dir), q, now=NOW).select("event_id", "event_type")


def filter_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {"bool": {"must": [{"term": {"quality": 1}}, {"term": {"toxic": {"value": 0}}}]}}
    return matching(read_table(spark, sf_dir, "labels"), q, now=NOW).select("doc_id")


def filter_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {"bool": {
        "must": [{"term": {"lang": "en"}}],
        "should": [{"prefix": {"source": "src1"}}, {"terms": {"source": ["src2", "src3"]}}],
        "minimum_should_match": 1,
        "must_not": [{"range": {"n_chars": {"gt": 5000}}}],
    }}
    return matching(read_table(spark, sf_dir, "documents"), q, now=NOW).select("doc_id", "source")


def filter_ids_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {"bool": {
        "should": [{"ids": {"values": [str(i) for i in range(0, 400, 7)]}},
                   {"bool": {"must": [{"exists": {"field": "props.k"}},
                                      {"range": {"props.k": {"gte": 95}}}],
                             "must_not": [{"exists": {"field": "props.nope"}},
                                          {"term": {"event_type": "view"}}]}}],
    }}
    view = event_documents(spark, sf_dir)
    return matching(view, q, now=NOW).select("event_id", "event_type")


def filter_nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job query over nested order documents (lookup and list index)."""
    q = {"bool": {"filter": [
        {"term": {"customer.segment": "BUILDING"}},
        {"range": {"totals.amount_cents": {"gte": 10000000}}},
        {"range": {"items[0].qty": {"lt": 25}}},
    ]}}
    view = order_documents(spark, sf_dir)
    bound, pred = bind_job(view, q, ["order_id"], now=NOW)
    return bound.frame.where(pred).select("order_id")


def filter_missing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing fields never match a positive clause, always match a negated one."""
    q = {"bool": {"must_not": [{"term": {"customer.no_such_field": "x"}}],
                  "should": [{"term": {"no_such_top": 1}}, {"term": {"status": "F"}}]}}
    view = order_documents(spark, sf_dir)
    bound, pred = bind_job(view, q, ["order_id"], now=NOW)
    return bound.frame.where(pred).select("order_id")


# One export job per event type plus a range and a bool job.
EVENT_JOBS = [
    ("events-click", {"term": {"event_type": "click"}}),
    ("events-view", {"term": {"event_type": "view"}}),
    ("events-purchase", {"term": {"event_type": "purchase"}}),
    ("events-signup", {"term": {"event_type": "signup"}}),
    ("events-error", {"term": {"event_type": "error"}}),
    ("events-none", {"term": {"event_type": "refund"}}),
    ("events-last-week", {"range": {"ts": {"gte": "now-7d/d"}}}),
    ("events-big-k", {"bool": {"filter": [{"range": {"props.k": {"gte": 50}}}],
                               "must_not": [{"term": {"event_type": "click"}}]}}),
]


def count_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_job(event_documents(spark, sf_dir), EVENT_JOBS, now=NOW)


def _count_expected_sql() -> str:
    conds = {
        "events-click": "event_type = 'click'",
        "events-view": "event_type = 'view'",
        "events-purchase": "event_type = 'purchase'",
        "events-signup": "event_type = 'signup'",
        "events-error": "event_type = 'error'",
        "events-none": "event_type = 'refund'",
        "events-last-week": "ts >= TIMESTAMP '2024-01-24 00:00:00'",
        "events-big-k": "CAST(json_extract(props, '$.k') AS DOUBLE) >= 50 AND event_type <> 'click'",
    }
    parts = [f"SELECT '{j}' AS job_id, CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS source_count FROM events"
             for j, c in conds.items()]
    return "\nUNION ALL\n".join(parts)


def export_filtered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter and projection together on order documents."""
    q = {"bool": {"filter": [{"terms": {"status": ["O", "P"]}},
                             {"range": {"order_date": {"gte": "1997-01-01"}}}]}}
    cols = ["order_id", "status", "customer", "first_sku"]
    paths = {"customer": "customer.name", "first_sku": "items[0].sku"}
    return project(order_documents(spark, sf_dir), cols, paths, query=q, now=NOW)


QUERIES = {
    "filter_match_all": (filter_match_all, lambda: f"SELECT {_LINE_KEYS_SQL} FROM lineitem"),
    "filter_range": (filter_range, lambda: f"""SELECT {_LINE_KEYS_SQL} FROM lineitem
WHERE l_quantity >= 10 AND l_quantity < 30
  AND l_shipdate > TIMESTAMP '1996-03-01 23:59:59.999999' AND l_shipdate <= TIMESTAMP '1998-06-30 12:00:00'"""),
    "filter_value_tables": (filter_value_tables, lambda: f"""SELECT {_LINE_KEYS_SQL} FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) AND l_quantity < 20
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""),
    "filter_big_ids": (filter_big_ids, lambda: f"""
WITH d AS (SELECT doc_id + {BIG} AS id FROM documents)
SELECT id, 'typed' AS kind FROM d
WHERE id IN ({BIG + 1}, {BIG + 2}, {BIG + 5}, {BIG + 11}, {BIG + 7}) OR id > {BIG + 20} AND id <= {BIG + 23}
UNION ALL SELECT id, 'loose' AS kind FROM d
WHERE id IN ({BIG + 1}, {BIG + 3}) OR id > {BIG + 20} AND id <= {BIG + 23}"""),
    "filter_date_only_bounds": (filter_date_only_bounds, lambda: _bounds_sql({
        "gt": "ts >= TIMESTAMP '2024-01-11'", "lte": "ts < TIMESTAMP '2024-01-11'",
        "gte": "ts >= TIMESTAMP '2024-01-10'", "lt": "ts < TIMESTAMP '2024-01-10'",
        "hour": "ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-10 06:31:00'"})),
    "filter_zoned_range": (filter_zoned_range, lambda: _bounds_sql({
        "zulu": "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
        "offset": "ts >= TIMESTAMP '2024-01-09 19:00:00' AND ts < TIMESTAMP '2024-01-11'",
        "zone": "ts >= TIMESTAMP '2024-01-09 19:00:00' AND ts < TIMESTAMP '2024-01-10 19:00:00'",
        "named": "ts >= TIMESTAMP '2024-01-10 05:00:00' AND ts < TIMESTAMP '2024-01-11 05:00:00'",
        "epoch": "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
        "round": "ts >= TIMESTAMP '2024-01-25 03:00:00' AND ts < TIMESTAMP '2024-01-26 03:00:00'"})),
    "filter_variant_lists": (filter_variant_lists, _variant_lists_sql),
    "filter_range_date_math": (filter_range_date_math, lambda: """SELECT event_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'"""),
    "filter_date_rounding": (filter_date_rounding, lambda: """SELECT event_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-26 00:00:00' AND ts <= TIMESTAMP '2024-01-29 23:59:59.999'"""),
    "filter_term": (filter_term, lambda: "SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0"),
    "filter_bool": (filter_bool, lambda: """SELECT doc_id, source FROM documents
WHERE coalesce(lang = 'en', false)
  AND (coalesce(starts_with(source, 'src1'), false) OR coalesce(source IN ('src2', 'src3'), false))
  AND NOT coalesce(n_chars > 5000, false)"""),
    "filter_ids_exists": (filter_ids_exists, lambda: f"""SELECT event_id, event_type FROM events
WHERE (event_id IN ({", ".join(str(i) for i in range(0, 400, 7))}))
   OR (json_extract(props, '$.k') IS NOT NULL AND json_type(json_extract(props, '$.k')) <> 'NULL'
       AND coalesce(CAST(json_extract(props, '$.k') AS DOUBLE) >= 95, false)
       AND NOT coalesce(event_type = 'view', false))"""),
    "filter_nested_paths": (filter_nested_paths, lambda: f"""WITH {ITEMS_CTE}
SELECT o.o_orderkey AS order_id
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1
WHERE coalesce(c.c_mktsegment = 'BUILDING', false)
  AND coalesce(CAST(round(o.o_totalprice * 100) AS BIGINT) >= 10000000, false)
  AND coalesce(i0.l_quantity < 25, false)"""),
    "filter_missing_field": (filter_missing_field, lambda: """SELECT o_orderkey AS order_id FROM orders
WHERE coalesce(o_orderstatus = 'F', false)"""),
    "count_expected": (count_expected, _count_expected_sql),
    "export_filtered_orders": (export_filtered_orders, lambda: f"""WITH {ITEMS_CTE}
SELECT {txt('o.o_orderkey')} AS order_id, {txt('o.o_orderstatus')} AS status,
  {txt('c.c_name')} AS customer, {txt('i0.l_partkey')} AS first_sku
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1
WHERE o.o_orderstatus IN ('O', 'P') AND o.o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"""),
}
