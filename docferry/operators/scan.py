"""Job-driven scans: filtered documents, counts, and many jobs in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.functions.paths import Key, tokenize, walk
from docferry.operators.predicates import compile_query
from docferry.operators.value_lists import among, take_lists
from docferry.sources.documents import Bound, DocumentView


#: Column of ``tag_jobs``; no document field has this name.
JOB_TAG = "__job_id"


def query_fields(query: Any) -> list[str]:
    """Every field path a query reads (so the scan binds its relations)."""
    out: list[str] = []
    if not isinstance(query, Mapping):
        return out
    for clause, body in query.items():
        if clause == "bool" and isinstance(body, Mapping):
            for key in ("must", "filter", "should", "must_not"):
                v = body.get(key, [])
                for q in (v if isinstance(v, list) else [v]):
                    out += query_fields(q)
        elif clause in ("range", "term", "terms", "prefix") and isinstance(body, Mapping):
            out += [k for k in body if k not in ("boost", "_name")]
        elif clause == "exists" and isinstance(body, Mapping) and isinstance(body.get("field"), str):
            out.append(body["field"])
    return out


def _query_resolver(bound: Bound):
    """Query fields fan out over lists of objects (any element may match)."""
    return lambda path: bound.resolve(path, fan_out=True)


def _id_of(view: DocumentView, bound: Bound):
    if not view.id_column:
        return None
    return F.col(f"`{view.id_column}`"), bound.frame.schema[view.id_column].dataType


def as_view(source: DocumentView | DataFrame, id_column: str | None = None) -> DocumentView:
    return source if isinstance(source, DocumentView) else DocumentView.of(source, id_column)


_LEAVES = ("term", "terms", "range", "prefix", "exists")


def _child_leaves(view: DocumentView, query: Any, out: list) -> Any:
    """Copy of ``query`` where each leaf whose field runs through a child list
    (``items.sku``) becomes a flag clause; the leaves are collected in ``out``."""
    if not isinstance(query, Mapping) or len(query) != 1:
        return query
    (clause, body), = query.items()
    if clause == "bool" and isinstance(body, Mapping):
        new = dict(body)
        for key in ("must", "filter", "should", "must_not"):
            if key in body:
                v = body[key]
                items = v if isinstance(v, list) else [v]
                new[key] = [_child_leaves(view, q, out) for q in items]
        return {"bool": new}
    if clause in _LEAVES and isinstance(body, Mapping):
        field = body.get("field") if clause == "exists" else next(
            (k for k in body if k not in ("boost", "_name")), None)
        steps = tokenize(field) if isinstance(field, str) else []
        if len(steps) >= 2 and isinstance(steps[0], Key) and steps[0].name in view.children \
                and isinstance(steps[1], Key):
            name = f"__any_{len(out)}"
            out.append((name, clause, body, field, steps))
            return {"__flag": name}
    return query


def _attach_child_flags(view: DocumentView, bound: Bound, leaves: list, now: datetime) -> None:
    """Per document, whether any child satisfies each collected leaf: leaves are
    evaluated on the child rows and combined with a boolean max per parent
    (map-side partial aggregation, so a parent with many children is one row
    per task), one aggregate and one join for each relation."""
    by_relation: dict[str, list] = {}
    for leaf in leaves:
        by_relation.setdefault(leaf[4][0].name, []).append(leaf)
    for relation, members in by_relation.items():
        ch = view.children[relation]
        elem = ch.frame.select(ch.value).schema[0].dataType

        def child_resolve(p, elem=elem):
            return walk(F.col("__v"), elem, tokenize(p), fan_out=True)

        flags = []
        for name, clause, body, field, steps in members:
            rest = ".".join(s.name if isinstance(s, Key) else f"[{s.pos}]" for s in steps[1:]).replace(".[", "[")
            if clause == "exists":
                sub = {"exists": {**body, "field": rest}}
            else:
                sub = {clause: {(rest if k == field else k): v for k, v in body.items()}}
            flags.append(F.max(compile_query(sub, child_resolve, now=now)).alias(name))
        parent = f"__any_{relation}_p"
        side = (ch.frame.select(F.col(ch.parent).alias(parent), ch.value.alias("__v"))
                .groupBy(parent).agg(*flags))
        bound.frame = bound.frame.join(side, bound.frame[view.id_column] == side[parent], "left").drop(parent)


def bind_job(source: DocumentView | DataFrame, query: Any, paths: Sequence[str], *,
             now: datetime, id_column: str | None = None, long_lists: bool = True,
             tables: Callable[[str], DataFrame] | None = None) -> tuple[Bound, Column]:
    """Bind the paths and the query's fields; return the frame and predicate.
    The frame has only rows that satisfy the query's long lists (unless
    ``long_lists`` is false), which the predicate then lacks."""
    view = as_view(source, id_column)
    leaves: list = []
    query, lists = take_lists(query, view, tables) if long_lists else (query, [])
    if view.children:
        query = _child_leaves(view, query, leaves)
    bound = view.bind(list(paths) + query_fields(query) + [column for column, _, _ in lists])
    for column, values, keep in lists:
        bound.frame = among(bound.frame, column, values, keep=keep)
    if leaves:
        _attach_child_flags(view, bound, leaves, now)
    pred = compile_query(query, _query_resolver(bound), now=now, id_column=_id_of(view, bound))
    return bound, pred


def matching(source: DocumentView | DataFrame, query: Any, *, now: datetime,
             id_column: str | None = None, tables: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The documents (root columns) that match ``query``. ``tables`` gives the
    value lists that the query names (see ``value_lists``)."""
    view = as_view(source, id_column)
    bound, pred = bind_job(view, query, [], now=now, tables=tables)
    return bound.frame.where(pred).select(*[F.col(f"`{c}`") for c in view.root.columns])


def count_matching(source: DocumentView | DataFrame, query: Any, *, now: datetime,
                   id_column: str | None = None, tables: Callable[[str], DataFrame] | None = None) -> int:
    """A1: how many documents ``query`` matches (one action, on the cluster)."""
    bound, pred = bind_job(source, query, [], now=now, id_column=id_column, tables=tables)
    return bound.frame.where(pred).count()


def tag_jobs(source: DocumentView | DataFrame, jobs: Sequence[tuple[str, Any]], *,
             now: datetime, paths: Sequence[str] = (), id_column: str | None = None
             ) -> tuple[Bound, DataFrame]:
    """Many jobs over one table in one scan.

    Each document gets the ids of the jobs whose query it matches and is
    repeated once per such job (column ``JOB_TAG``); a document matching no
    job is dropped in the scan stage.
    """
    view = as_view(source, id_column)
    leaves: list = []
    if view.children:  # one list for all jobs keeps the flag names unique
        jobs = [(job_id, _child_leaves(view, q, leaves)) for job_id, q in jobs]
    fields: list[str] = list(paths)
    for _, q in jobs:
        fields += query_fields(q)
    bound = view.bind(fields)
    if leaves:
        _attach_child_flags(view, bound, leaves, now)
    id_col = _id_of(view, bound)
    tags = [F.when(compile_query(q, _query_resolver(bound), now=now, id_column=id_col), F.lit(job_id))
            for job_id, q in jobs]
    tagged = bound.frame.withColumn(
        JOB_TAG, F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())))
    return bound, tagged


def tag_jobs_by_value(df: DataFrame, field: str, jobs: DataFrame) -> DataFrame:
    """Jobs that differ only in the value of one ``term``: ``jobs`` (job_id,
    value) is joined on it, so the plan doesn't grow with the job table. Spark
    broadcasts the jobs where they are small and shuffles both sides beyond."""
    jobs = jobs.select(F.col("job_id").alias(JOB_TAG), F.col("value").alias("__job_value"))
    return df.join(jobs, F.col(f"`{field}`") == F.col("__job_value")).drop("__job_value")


def count_per_job(source: DocumentView | DataFrame, jobs: Sequence[tuple[str, Any]], *,
                  now: datetime, id_column: str | None = None) -> DataFrame:
    """(job_id, source_count) for every job, zero included; one scan, and a
    shuffle of one partial count per job and task."""
    spark = (source.root if isinstance(source, DocumentView) else source).sparkSession
    _, tagged = tag_jobs(source, jobs, now=now, id_column=id_column)
    counts = tagged.groupBy(F.col(JOB_TAG).alias("job_id")).agg(F.count(F.lit(1)).alias("source_count"))
    ids = spark.createDataFrame([(j,) for j, _ in jobs], "job_id string")
    return (ids.join(counts, "job_id", "left")
            .select("job_id", F.coalesce("source_count", F.lit(0)).cast("bigint").alias("source_count")))


def envelope(source: DocumentView | DataFrame, *, sort: Sequence[str] | None = None,
             id_column: str | None = None) -> DataFrame:
    """Hits as envelopes ``(_id, _source, sort)`` instead of bare
    documents. ``_source`` is the document as a struct (or the variant of a
    schemaless document); ``sort`` holds the document's sort-key values."""
    view = as_view(source, id_column)
    root = view.root
    if view.variant_root is not None:
        src = F.col(f"`{view.variant_root}`")
    else:
        src = F.struct(*[F.col(f"`{c}`") for c in root.columns])
    keys = list(sort or ([view.id_column] if view.id_column else []))
    cols = [F.col(f"`{view.id_column}`").cast("string").alias("_id") if view.id_column
            else F.lit(None).cast("string").alias("_id"), src.alias("_source")]
    if keys:
        cols.append(F.array(*[F.col(f"`{k}`") for k in keys]).alias("sort"))
    return root.select(*cols)


def source_only(hits: DataFrame) -> DataFrame:
    """S5 default: the ``_source`` of each hit; a non-object source reads as an
    empty document."""
    dt = hits.schema["_source"].dataType
    if dt.typeName() == "struct":
        return hits.select("_source.*")
    return hits.select(F.when(F.schema_of_variant("_source").startswith("OBJECT"), F.col("_source"))
                       .alias("_source"))
