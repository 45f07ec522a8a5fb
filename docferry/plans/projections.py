"""Registered queries: document projection (P1-P10, V1, V4) and the flagship.

Each query is a function ``(spark, sf_dir) -> DataFrame`` paired with an
equivalent DuckDB statement over the same parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.operators.projection import project, with_line
from docferry.operators.scan import envelope
from docferry.plans.sqltext import ITEMS_CTE, csv_line_sql, ts_txt, txt
from docferry.sources.documents import (
    conversation_documents, event_documents, json_string_documents, order_documents)
from docferry.sources.tables import read_table

# The flagship export job: order documents -> four flat columns.
ORDER_EXPORT_COLUMNS = ["order_id", "customer", "amount", "first_sku"]
ORDER_EXPORT_PATHS = {
    "order_id": "order_id",
    "customer": "customer.name",
    "amount": "totals.amount_cents",
    "first_sku": "items[0].sku",
}


def export_order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project(order_documents(spark, sf_dir), ORDER_EXPORT_COLUMNS, ORDER_EXPORT_PATHS)
    return with_line(rows, ORDER_EXPORT_COLUMNS)


_ORDER_FROM = """FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""


def _export_order_docs_sql() -> str:
    cells = [txt("o.o_orderkey"), txt("c.c_name"),
             txt("CAST(round(o.o_totalprice * 100) AS BIGINT)"), txt("i0.l_partkey")]
    return f"""WITH {ITEMS_CTE},
cells AS (
  SELECT {cells[0]} AS order_id, {cells[1]} AS customer, {cells[2]} AS amount,
         {cells[3]} AS first_sku
  {_ORDER_FROM}
  LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1)
SELECT *, {csv_line_sql(ORDER_EXPORT_COLUMNS)} AS line FROM cells"""


def path_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["order_id", "customer_name", "segment", "nation_key", "amount_cents", "price"]
    paths = {"customer_name": "customer.name", "segment": "customer.segment",
             "nation_key": "customer.nation_key", "amount_cents": "totals.amount_cents",
             "price": "totals.price"}
    return project(order_documents(spark, sf_dir), cols, paths)


def _path_nested_sql() -> str:
    return f"""SELECT {txt('o.o_orderkey')} AS order_id, {txt('c.c_name')} AS customer_name,
  {txt('c.c_mktsegment')} AS segment, {txt('c.c_nationkey')} AS nation_key,
  {txt('CAST(round(o.o_totalprice * 100) AS BIGINT)')} AS amount_cents,
  {txt('o.o_totalprice')} AS price
{_ORDER_FROM}"""


def path_list_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["order_id", "sku0", "sku1", "sku6", "line3"]
    paths = {"sku0": "items[0].sku", "sku1": "items[1].sku", "sku6": "items[6].sku",
             "line3": "items[3].line"}
    return project(order_documents(spark, sf_dir), cols, paths)


def _path_list_index_sql() -> str:
    return f"""WITH {ITEMS_CTE}
SELECT {txt('o.o_orderkey')} AS order_id, {txt('i0.l_partkey')} AS sku0,
  {txt('i1.l_partkey')} AS sku1, {txt('i6.l_partkey')} AS sku6, {txt('i3.l_linenumber')} AS line3
FROM orders o
LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1
LEFT JOIN items i1 ON i1.l_orderkey = o.o_orderkey AND i1.rn = 2
LEFT JOIN items i3 ON i3.l_orderkey = o.o_orderkey AND i3.rn = 4
LEFT JOIN items i6 ON i6.l_orderkey = o.o_orderkey AND i6.rn = 7"""


def path_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["order_id", "flag1", "ship_date0", "qty2", "price0", "discount0"]
    paths = {"flag1": "items[1].ship.flag", "ship_date0": "items[0].ship.date",
             "qty2": "items[2].qty", "price0": "items[0].price", "discount0": "items[0].discount"}
    return project(order_documents(spark, sf_dir), cols, paths)


def _path_mixed_sql() -> str:
    return f"""WITH {ITEMS_CTE}
SELECT {txt('o.o_orderkey')} AS order_id, {txt('i1.l_returnflag')} AS flag1,
  {ts_txt('i0.l_shipdate')} AS ship_date0, {txt('i2.l_quantity')} AS qty2,
  {txt('i0.l_extendedprice')} AS price0, {txt('i0.l_discount')} AS discount0
FROM orders o
LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1
LEFT JOIN items i1 ON i1.l_orderkey = o.o_orderkey AND i1.rn = 2
LEFT JOIN items i2 ON i2.l_orderkey = o.o_orderkey AND i2.rn = 3"""


def path_missing_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["order_id", "no_field", "no_item_field", "index_on_object", "key_on_scalar",
            "dot_only", "key_on_list", "double_dot", "index_on_scalar", "bad_index"]
    paths = {"no_field": "customer.missing", "no_item_field": "items[0].nope",
             "index_on_object": "totals[0]", "key_on_scalar": "order_id.x",
             "dot_only": ".", "key_on_list": "items.sku", "double_dot": "customer..name",
             "index_on_scalar": "items[0].sku[0]", "bad_index": "items[-1].sku"}
    return project(order_documents(spark, sf_dir), cols, paths)


def _path_missing_to_empty_sql() -> str:
    return f"""SELECT {txt('o.o_orderkey')} AS order_id, '' AS no_field, '' AS no_item_field,
  '' AS index_on_object, '' AS key_on_scalar, '' AS dot_only, '' AS key_on_list,
  {txt('c.c_name')} AS double_dot, '' AS index_on_scalar, '' AS bad_index
{_ORDER_FROM}"""


def path_whole_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["order_id", "customer"]
    return project(order_documents(spark, sf_dir), cols, {"customer": "customer"})


def _path_whole_values_sql() -> str:
    return f"""SELECT {txt('o.o_orderkey')} AS order_id,
  CASE WHEN c.c_custkey IS NULL THEN '' ELSE
    '{{"name": ' || CAST(to_json(c.c_name) AS VARCHAR)
    || ', "segment": ' || CAST(to_json(c.c_mktsegment) AS VARCHAR)
    || ', "nation_key": ' || CAST(c.c_nationkey AS VARCHAR)
    || ', "balance_cents": ' || CAST(CAST(round(c.c_acctbal * 100) AS BIGINT) AS VARCHAR) || '}}'
  END AS customer
{_ORDER_FROM}"""


def path_default_and_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["o_orderpriority", "o_orderkey", "o_totalprice", "o_orderdate", "o_custkey",
            "not_a_column", "ORDERKEY"]
    return project(read_table(spark, sf_dir, "orders"), cols)


def _path_default_and_order_sql() -> str:
    return f"""SELECT {txt('o_orderpriority')} AS o_orderpriority, {txt('o_orderkey')} AS o_orderkey,
  {txt('o_totalprice')} AS o_totalprice, {ts_txt('o_orderdate')} AS o_orderdate,
  {txt('o_custkey')} AS o_custkey, '' AS not_a_column, '' AS "ORDERKEY"
FROM orders"""


def path_variant_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["event_id", "k", "k_missing", "props", "k_index"]
    paths = {"k": "props.k", "k_missing": "props.q", "k_index": "props[0]"}
    return project(event_documents(spark, sf_dir), cols, paths)


def _path_variant_json_sql() -> str:
    return f"""SELECT {txt('event_id')} AS event_id,
  coalesce(json_extract_string(props, '$.k'), '') AS k,
  coalesce(json_extract_string(props, '$.q'), '') AS k_missing,
  coalesce(replace(replace(CAST(json(props) AS VARCHAR), ':', ': '), ',', ', '), '') AS props,
  '' AS k_index
FROM events"""


def path_array_primitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["vec_id", "e0", "e1", "e_far", "label"]
    paths = {"e0": "embedding[0]", "e1": "embedding[1]", "e_far": "embedding[9999]"}
    return project(read_table(spark, sf_dir, "embeddings"), cols, paths)


def _path_array_primitive_sql() -> str:
    return f"""SELECT {txt('vec_id')} AS vec_id, {txt('embedding[1]')} AS e0,
  {txt('embedding[2]')} AS e1,
  coalesce(CAST(CASE WHEN len(embedding) > 9999 THEN embedding[10000] END AS VARCHAR), '') AS e_far,
  {txt('label')} AS label
FROM embeddings"""


def path_conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["conv_id", "first_role", "first_text", "second_role", "turn_no"]
    paths = {"first_role": "turns[0].role", "first_text": "turns[0].text",
             "second_role": "turns[1].role", "turn_no": "turns[1].turn"}
    return project(conversation_documents(spark, sf_dir), cols, paths)


def _path_conversation_turns_sql() -> str:
    return f"""WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn
  FROM conversations),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT {txt('ids.conv_id')} AS conv_id, {txt('t0.role')} AS first_role,
  {txt('t0.text')} AS first_text, {txt('t1.role')} AS second_role, {txt('t1.turn')} AS turn_no
FROM ids
LEFT JOIN t t0 ON t0.conv_id = ids.conv_id AND t0.rn = 1
LEFT JOIN t t1 ON t1.conv_id = ids.conv_id AND t1.rn = 2"""


def order_json_documents(spark: SparkSession, sf_dir: str):
    """Orders as schemaless JSON documents (one JSON text per order)."""
    orders = read_table(spark, sf_dir, "orders")
    doc = F.to_json(F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.struct(F.col("o_custkey").alias("key")).alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.array("o_orderstatus", "o_orderpriority").alias("flags"),
        F.col("o_totalprice").alias("price"),
        F.lit(None).cast("string").alias("note")), {"ignoreNullFields": "false"})
    return json_string_documents(orders.select("o_orderkey", doc.alias("doc")), "doc",
                                 id_column="o_orderkey")


def path_schemaless_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["_id", "order_id", "customer_key", "priority", "note", "nope", "customer"]
    paths = {"customer_key": "customer.key", "priority": "flags[1]", "nope": "flags[2]",
             "customer": "customer"}
    return project(order_json_documents(spark, sf_dir), cols, paths)


def _path_schemaless_docs_sql() -> str:
    return f"""SELECT {txt('o_orderkey')} AS _id, {txt('o_orderkey')} AS order_id,
  {txt('o_custkey')} AS customer_key, {txt('o_orderpriority')} AS priority,
'' AS note, '' AS nope,
  '{{"key": ' || CAST(o_custkey AS VARCHAR) || '}}' AS customer
FROM orders"""


def path_map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 on a map: documents carry their label scores as ``map<string,int>``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.create_map(F.lit("quality"), F.col("quality"),
                               F.lit("toxic"), F.col("toxic")).alias("scores"))
    view = docs.join(labels, "doc_id", "left")
    cols = ["_id", "lang", "quality", "toxic", "other", "scores"]
    paths = {"quality": "scores.quality", "toxic": "scores.toxic", "other": "scores.other"}
    return project(view, cols, paths, id_column="doc_id")


def _path_map_values_sql() -> str:
    return f"""SELECT {txt('d.doc_id')} AS _id, {txt('d.lang')} AS lang,
  {txt('l.quality')} AS quality, {txt('l.toxic')} AS toxic, '' AS other,
  CASE WHEN l.doc_id IS NULL THEN ''
       ELSE '{{"quality": ' || CAST(l.quality AS VARCHAR) || ', "toxic": ' || CAST(l.toxic AS VARCHAR) || '}}'
  END AS scores
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def path_whole_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path ending on a whole child list: each conversation's turns as JSON
    (the list is gathered per document, in turn order)."""
    cols = ["conv_id", "turns", "n_missing"]
    return project(conversation_documents(spark, sf_dir), cols, {"n_missing": "turns.turn"})


def _path_whole_list_sql() -> str:
    return f"""SELECT {txt('conv_id')} AS conv_id,
  '[' || string_agg('{{"turn": ' || CAST(turn AS VARCHAR) || ', "role": ' || CAST(to_json(role) AS VARCHAR)
                    || ', "text": ' || CAST(to_json(text) AS VARCHAR) || '}}', ', '
                    ORDER BY turn, role, text) || ']' AS turns,
  '' AS n_missing
FROM conversations GROUP BY conv_id"""


def project_doc_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["_id", "lang", "source", "n_chars"]
    return project(read_table(spark, sf_dir, "documents"), cols, id_column="doc_id")


def _project_doc_id_sql() -> str:
    return f"""SELECT {txt('doc_id')} AS _id, {txt('lang')} AS lang, {txt('source')} AS source,
  {txt('n_chars')} AS n_chars
FROM documents"""


def source_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hit envelope ``_id`` / ``_source`` / ``sort`` of label documents."""
    hits = envelope(read_table(spark, sf_dir, "labels"), id_column="doc_id")
    return hits.select("_id", F.to_json("_source").alias("_source"), "sort")


def _source_envelope_sql() -> str:
    return """SELECT CAST(doc_id AS VARCHAR) AS _id,
  CAST(to_json(struct_pack(doc_id := doc_id, quality := quality, toxic := toxic)) AS VARCHAR) AS _source,
  [doc_id] AS sort
FROM labels"""


QUERIES = {
    "export_order_docs": (export_order_docs, _export_order_docs_sql),
    "path_nested": (path_nested, _path_nested_sql),
    "path_list_index": (path_list_index, _path_list_index_sql),
    "path_mixed": (path_mixed, _path_mixed_sql),
    "path_missing_to_empty": (path_missing_to_empty, _path_missing_to_empty_sql),
    "path_whole_values": (path_whole_values, _path_whole_values_sql),
    "path_default_and_order": (path_default_and_order, _path_default_and_order_sql),
    "path_variant_json": (path_variant_json, _path_variant_json_sql),
    "path_array_primitive": (path_array_primitive, _path_array_primitive_sql),
    "path_conversation_turns": (path_conversation_turns, _path_conversation_turns_sql),
    "project_doc_id": (project_doc_id, _project_doc_id_sql),
    "path_schemaless_docs": (path_schemaless_docs, _path_schemaless_docs_sql),
    "path_map_values": (path_map_values, _path_map_values_sql),
    "path_whole_list": (path_whole_list, _path_whole_list_sql),
    "source_envelope": (source_envelope, _source_envelope_sql),
}
