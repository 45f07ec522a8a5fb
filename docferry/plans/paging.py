"""Registered queries: keyset pages, page numbers, preview (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docferry.operators.paging import keyset_page, page_numbers, preview
from docferry.sources.tables import read_table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEYS_SQL = ", ".join(KEYS)
# The page request of the keyset query.
PAGE_SIZE = 1000
CURSOR = (1000, 3, 0, 0)


def keyset_page_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*KEYS, "l_quantity")
    return keyset_page(li, KEYS, PAGE_SIZE, CURSOR)


def page_numbers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*KEYS)
    return page_numbers(li, KEYS, PAGE_SIZE)


def preview_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                   ["o_orderkey"], 10)


QUERIES = {
    "keyset_page": (keyset_page_query, lambda: f"""SELECT {_KEYS_SQL}, l_quantity FROM lineitem
WHERE (l_orderkey, l_linenumber, l_partkey, l_suppkey) > {CURSOR}
ORDER BY {_KEYS_SQL} LIMIT {PAGE_SIZE}"""),
    "page_numbers": (page_numbers_query, lambda: f"""SELECT {_KEYS_SQL},
  CAST(floor((row_number() OVER (ORDER BY {_KEYS_SQL}) - 1) / {PAGE_SIZE}) AS BIGINT) AS page
FROM lineitem"""),
    "preview_limit": (preview_query, lambda: """SELECT o_orderkey, o_orderstatus FROM orders
ORDER BY o_orderkey LIMIT 10"""),
}
