"""All registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docferry.session import tune


def _modules():
    from docferry.plans import (
        control_jobs, filters, integrity, many_jobs, ordered, paging, projections, rendering, statistics)

    return [projections, filters, rendering, control_jobs, paging, ordered, many_jobs, integrity, statistics]


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for m in _modules():
        for name, (fn, _sql) in m.QUERIES.items():
            out[name] = _wrap(fn)
    return out


def oracle_sql() -> dict[str, str]:
    out = {}
    for m in _modules():
        for name, (_fn, sql) in m.QUERIES.items():
            if sql is not None:
                out[name] = sql()
    return out
