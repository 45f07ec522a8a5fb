"""Job table: validation, defaults and lookup (J1-J3), plus delivery plans.

Job definitions are schemaless JSON documents ``(_id, doc)``, as a document
store keeps them; they are read as ``variant`` so types can be checked the
way the source system checks decoded JSON. Rules, first failure wins:

1. ``not_found``: no job with that id (lookup only);
2. ``missing_fields``: any of data_index, query, columns, remote_filename
   absent (a key holding JSON null counts as present);
3. ``query_not_object`` / ``query_empty``;
4. ``columns_not_strings`` (not a list of strings) / ``columns_empty``;
5. ``column_paths_not_strings`` (null or absent means ``{}``);
6. ``bad_remote_filename`` (not a non-empty string, or with a ``.`` or ``..``
   segment).

Defaults: ``job_id`` is the document id when absent or null; ``job_id`` and
``data_index`` of another JSON type are taken as their JSON text.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.functions.render import basename

REQUIRED = ("data_index", "query", "columns", "remote_filename")


def _get(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, f'$["{key}"]', "variant")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _text(v: Column) -> Column:
    """Text of a JSON value: strings as is, anything else as its JSON."""
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def validate_jobs(jobs: DataFrame, *, id_col: str = "_id", doc_col: str = "doc") -> DataFrame:
    """(_id, doc JSON) -> one row per job with typed fields and ``error``."""
    parsed = jobs.select(F.col(id_col).alias("_id"), F.col(doc_col).isNull().alias("_absent"),
                         F.try_parse_json(F.col(doc_col)).alias("_doc"))
    doc = F.col("_doc")
    fields = parsed.select(
        "_id", "_absent", F.coalesce(_kind(doc).startswith("OBJECT"), F.lit(False)).alias("_object"),
        *[_get(doc, k).alias(f"_{k}") for k in REQUIRED + ("column_paths", "job_id")])
    query, columns, paths, remote, jid = (F.col("_query"), F.col("_columns"), F.col("_column_paths"),
                                          F.col("_remote_filename"), F.col("_job_id"))
    missing = None
    for k in REQUIRED:
        cond = F.col(f"_{k}").isNull()
        missing = cond if missing is None else (missing | cond)
    kinds = fields.select(
        "*", _kind(query).alias("_qk"), _kind(columns).alias("_ck"), _kind(paths).alias("_pk"),
        (paths.isNull() | F.is_variant_null(paths)).alias("_paths_absent"),
        F.try_variant_get(paths, "$", "map<string,variant>").alias("_paths_map"))
    paths_ok = F.col("_paths_absent") | F.coalesce(
        F.col("_pk").startswith("OBJECT")
        & F.forall(F.map_values("_paths_map"), lambda v: _kind(v) == "STRING"), F.lit(False))
    error = (
        F.when(F.col("_absent") | ~F.col("_object"), F.lit("missing_fields"))
        .when(missing, F.lit("missing_fields"))
        .when(~F.col("_qk").startswith("OBJECT"), F.lit("query_not_object"))
        .when(F.col("_qk") == "OBJECT<>", F.lit("query_empty"))
        .when(~F.col("_ck").isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit("columns_not_strings"))
        .when(F.col("_ck") == "ARRAY<VOID>", F.lit("columns_empty"))
        .when(~paths_ok, F.lit("column_paths_not_strings"))
        .when(~F.coalesce((_kind(remote) == "STRING")
                          & (F.try_variant_get(remote, "$", "string") != "")
                          & ~F.try_variant_get(remote, "$", "string").rlike("(^|/)\\.{1,2}(/|$)"), F.lit(False)),
              F.lit("bad_remote_filename")))
    return kinds.select(
        F.col("_id").alias("job_doc_id"),
        F.when(jid.isNull() | F.is_variant_null(jid), F.col("_id")).otherwise(_text(jid)).alias("job_id"),
        _text(F.col("_data_index")).alias("data_index"),
        F.to_json(query).alias("query"),
        F.when(F.col("_ck").isin("ARRAY<STRING>", "ARRAY<VOID>"),
               F.try_variant_get(columns, "$", "array<string>")).alias("columns"),
        F.when(F.col("_paths_absent"), F.create_map().cast("map<string,string>"))
        .otherwise(F.try_variant_get(paths, "$", "map<string,string>")).alias("column_paths"),
        F.try_variant_get(remote, "$", "string").alias("remote_filename"),
        error.alias("error"),
    )


def lookup_jobs(control: DataFrame, jobs: DataFrame, *, prefilter: bool = False) -> DataFrame:
    """Decoded control records -> their validated job (left join).

    Rejected records keep their decode error; an unknown id is ``not_found``.
    The job table is small next to a stream of records only in the common
    case, so the join is left to Spark (it broadcasts the job side when its
    size is under the broadcast threshold, else shuffles both).
    """
    # ``prefilter``: validate only the jobs the records name (a semi-join on
    # the id first) — for a small batch of records against a large job table.
    # It reads the records twice, so it is off for large record sets.
    if prefilter:
        wanted = (control.select(F.col("job_doc_id").alias("_want"))
                  .where(F.col("_want").isNotNull()).distinct())
        jobs = jobs.join(wanted, jobs["_id"] == wanted["_want"], "left_semi")
    v = validate_jobs(jobs).withColumnRenamed("error", "job_error")
    j = control.join(v, "job_doc_id", "left")
    err = (F.when(F.col("error").isNotNull(), F.col("error"))
           .when(F.col("job_id").isNull(), F.lit("not_found"))
           .otherwise(F.col("job_error")))
    return j.withColumn("error", err).drop("job_error")


def safe_name(c: Column) -> Column:
    """A job id usable as one path segment (as the export stages it): safe
    ids unchanged, others cleaned and suffixed with a short digest."""
    cleaned = F.concat(F.regexp_replace(c, "[^A-Za-z0-9._-]", "_"), F.lit("-"),
                       F.substring(F.md5(c), 1, 8))
    return F.when(c.rlike("^[A-Za-z0-9._-]+$") & ~c.isin(".", ".."), c).otherwise(cleaned)


def delivery_plan(jobs: DataFrame, staging_root: str) -> DataFrame:
    """W5 + V8: per valid job, the export goes first, its sidecar second.

    Staging is ``<root>/<job_id>/`` so jobs with equal file names in
    different remote folders never overwrite each other.
    """
    base = F.concat(F.lit(staging_root.rstrip("/") + "/"), safe_name(F.col("job_id")), F.lit("/"))
    ok = jobs.where(F.col("error").isNull())
    csv_row = ok.select("job_id", F.lit(1).alias("seq"),
                        F.concat(base, basename(F.col("remote_filename"))).alias("local"),
                        F.col("remote_filename").alias("remote"))
    side_row = ok.select("job_id", F.lit(2).alias("seq"),
                         F.concat(base, basename(F.col("remote_filename")), F.lit(".sha256")).alias("local"),
                         F.concat(F.col("remote_filename"), F.lit(".sha256")).alias("remote"))
    return csv_row.unionByName(side_row)


@dataclass(frozen=True)
class JobSpec:
    """A validated job, on the driver (one per control record / job run)."""

    job_id: str
    data_index: str
    query: dict[str, Any]
    columns: list[str]
    column_paths: dict[str, str] = field(default_factory=dict)
    remote_filename: str = ""

    @classmethod
    def from_row(cls, row) -> JobSpec:
        if row["error"] is not None:
            raise ValueError(f"job {row['job_doc_id']}: {row['error']}")
        return cls(job_id=row["job_id"], data_index=row["data_index"],
                   query=json.loads(row["query"]), columns=list(row["columns"]),
                   column_paths=dict(row["column_paths"] or {}),
                   remote_filename=row["remote_filename"])


class JobSpecError(ValueError):
    """A job that is missing or fails validation."""

    def __init__(self, job_doc_id: str, reason: str) -> None:
        super().__init__(f"job {job_doc_id}: {reason}")
        self.job_doc_id = job_doc_id
        self.reason = reason


def load_job(jobs: DataFrame, job_doc_id: str, *, id_col: str = "_id", doc_col: str = "doc") -> JobSpec:
    """S2 + J1-J3 for one id: point lookup in the job table, validated.

    The filter on the id reaches the job table's scan; one row comes back."""
    rows = validate_jobs(jobs.where(F.col(id_col) == F.lit(job_doc_id)), id_col=id_col,
                         doc_col=doc_col).limit(2).collect()
    if not rows:
        raise JobSpecError(job_doc_id, "not_found")
    if len(rows) > 1:
        raise JobSpecError(job_doc_id, "duplicate_id")
    if rows[0]["error"] is not None:
        raise JobSpecError(job_doc_id, rows[0]["error"])
    return JobSpec.from_row(rows[0])
