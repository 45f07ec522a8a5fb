"""Counts from file statistics (A1): a job's expected count without its rows.

Parquet footers hold each column's least and greatest value and its nulls.
``count_by_statistics`` reads them through Spark's aggregate push-down (the
parquet reader answers ``min``, ``max`` and ``count`` by partition from footers
alone: ``PushedAggregation`` in the plan), decides for every partition of the
table whether the query holds for all its rows, for none, or for some, and
scans only the partitions of the last kind.

Which queries: ``match_all``, ``exists``, ``range``, ``term`` on whole numbers,
and ``bool`` with ``must`` and ``filter`` over these. A clause is decided by
evaluating it, compiled as for the scan, on the least and the greatest value: a
lower bound that the least value meets is met by all, one that the greatest
fails by none. Anything else (``should``, ``must_not``, ``prefix``, text, doubles,
whose statistics leave NaN out, timestamps, whose statistics Spark doesn't use)
says nothing, and the partitions that the other clauses leave open are scanned
with the whole query; the result always equals the scan's.

Defined cases: a null partition value is a partition of its own and is scanned;
an empty table counts 0; where a file has no statistics for a column that is
asked for (older writers, row groups of nulls only) all partitions are scanned.
"""

from __future__ import annotations

import functools
import operator
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.paths import Resolved
from docferry.operators.predicates import compile_query
from docferry.operators.scan import bind_job
from docferry.session import checkpoint_dir

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FIRM = (*_WHOLE, T.DateType)  # types whose footers' least and greatest value count
ALL, SOME, NONE = "all", "some", "none"


@contextmanager
def _footers_only(spark: SparkSession):
    """Parquet through the reader that answers aggregates from footers. What
    is read in here must also be run in here."""
    sources = "spark.sql.sources.useV1SourceList"
    wanted = {sources: ",".join(s for s in spark.conf.get(sources).split(",") if s.strip() != "parquet"),
              "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _clauses(query: Any) -> list[tuple[str, Any] | None]:
    """The conjunction a query is: (clause, body) each; None where a part says
    nothing."""
    if not isinstance(query, Mapping) or len(query) != 1:
        return [None]
    (clause, body), = query.items()
    if clause == "match_all":
        return []
    if clause == "bool" and isinstance(body, Mapping):
        out: list = []
        for key in ("must", "filter"):
            v = body.get(key, [])
            for q in v if isinstance(v, list) else [v]:
                out += _clauses(q)
        if not (body.get("must") or body.get("filter")) or set(body) - {"must", "filter"}:
            out.append(None)
        return out
    return [(clause, body)]


def _field(clause: str, body: Any) -> str | None:
    if not isinstance(body, Mapping):
        return None
    if clause == "exists":
        return body.get("field") if isinstance(body.get("field"), str) else None
    names = [k for k in body if k not in ("boost", "_name")]
    return names[0] if clause in ("range", "term") and len(names) == 1 else None


def _verdict(clause: str, body: Any, field: str, dt: T.DataType, stat: Mapping[str, Column],
             now: datetime) -> tuple[Column, Column]:
    """(holds for all rows, holds for none) of one clause."""
    empty = stat["count"] == 0
    full = stat["count"] == stat["rows"]
    if clause == "exists":
        return full, empty

    def on(q: Mapping, value: Column) -> Column:
        return compile_query(q, lambda _: Resolved(value, dt), now=now)

    spec = body[field]
    if clause == "term":
        value = spec["value"] if isinstance(spec, Mapping) else spec
        spec = {"gte": value, "lte": value}
    options = {k: v for k, v in spec.items() if k not in ("gte", "gt", "lte", "lt")}
    every, none = full, empty
    for key in ("gte", "gt", "lte", "lt"):
        if key in spec:
            q = {"range": {field: {**options, key: spec[key]}}}
            near, far = (stat["min"], stat["max"]) if key[0] == "g" else (stat["max"], stat["min"])
            every, none = every & on(q, near), none | ~on(q, far)
    return every, none


def partition_statistics(spark: SparkSession, path: str, columns: Sequence[str],
                         partitions: Sequence[str] = ()) -> DataFrame:
    """rows, and min_i, max_i and count_i of ``columns``, by partition, read from
    footers. Plan and run it inside ``_footers_only``."""
    table = spark.read.parquet(path)
    types = {f.name: f.dataType for f in table.schema.fields}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count(f"`{c}`").alias(f"count_{i}"))
        if isinstance(types[c], _FIRM):
            aggs += [F.min(f"`{c}`").alias(f"min_{i}"), F.max(f"`{c}`").alias(f"max_{i}")]
    return table.groupBy(*[f"`{p}`" for p in partitions]).agg(*aggs)


def judged_partitions(spark: SparkSession, path: str, query: Any, *, now: datetime,
                      partitions: Sequence[str] = ()) -> DataFrame:
    """The partition columns, rows and ``verdict`` (all, some, none) of every
    partition, from footers alone. Plan and run it inside ``_footers_only``."""
    types = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    parts = _clauses(query)
    usable = []
    for part in parts:
        field = _field(*part) if part else None
        dt = types.get(field)
        firm = dt is not None and not isinstance(dt, (T.StructType, T.ArrayType, T.MapType, T.VariantType)) and (
            part[0] == "exists" or isinstance(dt, _FIRM) and (part[0] == "range" and isinstance(part[1][field], Mapping)
                                                              or part[0] == "term" and isinstance(dt, _WHOLE)))
        usable.append((*part, field) if firm else None)
    columns = list(dict.fromkeys(u[2] for u in usable if u and u[2] not in partitions))
    stats = partition_statistics(spark, path, columns, partitions)
    every, none = F.lit(True), F.col("rows") == 0
    for u in usable:
        if u is None:
            every = F.lit(False)
            continue
        clause, body, field = u
        if field in partitions:
            value = F.col(f"`{field}`")
            stat = {"rows": F.col("rows"), "count": F.when(value.isNull(), 0).otherwise(F.col("rows")),
                    "min": value, "max": value}
        else:
            i = columns.index(field)
            stat = {"rows": F.col("rows"), "count": F.col(f"count_{i}")}
            if isinstance(types[field], _FIRM):
                stat |= {"min": F.col(f"min_{i}"), "max": F.col(f"max_{i}")}
        a, n = _verdict(clause, body, field, types[field], stat, now)
        every, none = every & a, none | n
    verdict = F.when(none, NONE).when(every, ALL).otherwise(SOME)
    if partitions:
        known = functools.reduce(operator.and_, [F.col(f"`{p}`").isNotNull() for p in partitions])
        verdict = F.when(known, verdict).otherwise(SOME)
    return stats.select(*[F.col(f"`{p}`") for p in partitions], "rows", verdict.alias("verdict"))


def count_by_statistics(spark: SparkSession, path: str, query: Any, *, now: datetime,
                        partitions: Sequence[str] = ()) -> DataFrame:
    """One row: source_count, and of it from_statistics (the rows of partitions
    that weren't read). ``partitions`` names all partition columns of the
    parquet table in ``path``."""
    kept = f"{checkpoint_dir(spark).rstrip('/')}/statistics/{uuid.uuid4().hex}"
    source = spark.read.parquet(path)
    bound, pred = bind_job(source, query, [], now=now, long_lists=False)
    matching = bound.frame.where(pred)
    try:
        with _footers_only(spark):
            judged_partitions(spark, path, query, now=now, partitions=partitions).write.parquet(kept)
    except (PySparkException, Py4JJavaError) as e:
        if "No min/max found" not in str(e):
            raise
        return matching.agg(F.count(F.lit(1)).alias("source_count"), F.lit(0).cast("bigint").alias("from_statistics"))
    judged = spark.read.parquet(kept)
    known = judged.where(F.col("verdict") == ALL).select(F.col("rows").alias("n"), F.col("rows").alias("known"))
    some = judged.where(F.col("verdict") == SOME)
    counts = []
    if partitions:
        nulls = functools.reduce(operator.or_, [F.col(f"`{p}`").isNull() for p in partitions])
        # Equal keys, so that the open partitions prune the scan.
        counts.append(matching.join(some.select(*[F.col(f"`{p}`") for p in partitions]), list(partitions), "left_semi"))
        counts.append(matching.where(nulls))
    elif not some.isEmpty():
        counts.append(matching)
    for rows in counts:
        known = known.unionByName(rows.agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.lit(0).cast("bigint")))
    return known.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("source_count"),
                     F.coalesce(F.sum("known"), F.lit(0)).cast("bigint").alias("from_statistics"))
