"""Small helpers that write the DuckDB side of the oracle queries."""

from __future__ import annotations


def csvq(expr: str) -> str:
    """SQL for one CSV field with minimal quoting (mirror of ``csv_field``)."""
    return (f"(CASE WHEN regexp_matches({expr}, '[,\"\\r\\n]') "
            f"THEN '\"' || replace({expr}, '\"', '\"\"') || '\"' ELSE {expr} END)")


def csv_line_sql(exprs: list[str]) -> str:
    if len(exprs) == 1:
        return f"(CASE WHEN {exprs[0]} = '' THEN '\"\"' ELSE {csvq(exprs[0])} END)"
    return " || ',' || ".join(csvq(e) for e in exprs)


def txt(expr: str) -> str:
    """Cell text of a scalar (null -> '')."""
    return f"coalesce(CAST({expr} AS VARCHAR), '')"


def ts_txt(expr: str) -> str:
    return f"coalesce(strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f'), '')"


ITEMS_CTE = """items AS (
  SELECT l.*, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem l)"""
