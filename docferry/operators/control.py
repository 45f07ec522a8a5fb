"""Control records: decode and route (T1-T3, V6, V9), as column expressions.

A control record is ``(value, partition, offset)``; ``value`` holds one JSON
object naming the job (``job_doc_id``, or ``id`` when ``job_doc_id`` is
falsy) and an optional string ``correlation_id``. Decoding is stateless, so
it runs the same on a batch DataFrame and on a stream.

``error`` is null for a usable record, else one of (first that applies):
``null_value``, ``undecodable`` (not UTF-8, not JSON), ``not_an_object``,
``missing_job_doc_id`` (absent, falsy or not a non-empty string),
``bad_correlation_id`` (present, not null and not a string).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reject reasons, in the order they are checked.
NULL_VALUE = "null_value"
UNDECODABLE = "undecodable"
NOT_AN_OBJECT = "not_an_object"
MISSING_JOB_DOC_ID = "missing_job_doc_id"
BAD_CORRELATION_ID = "bad_correlation_id"

_NUMERIC_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def is_truthy(v: Column, kind: Column | None = None) -> Column:
    """Python truthiness of a JSON value held as variant (missing -> false).
    ``kind`` is ``schema_of_variant(v)`` when the caller already has it."""
    kind = F.schema_of_variant(v) if kind is None else kind
    return F.coalesce(
        F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string") != "")
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind.isin(*_NUMERIC_KINDS) | kind.startswith("DECIMAL"),
              F.try_variant_get(v, "$", "double") != 0)
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .otherwise(F.lit(True)),
        F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def barrier(df: DataFrame, keep: list[str], computed: list[str]) -> DataFrame:
    """Re-emit ``computed`` columns as generator output (a one-element
    ``inline``). A later filter or join on them cannot be pushed back into
    the expressions that made them, so each is evaluated once per row."""
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))


def decode_control(records: DataFrame, *, value: str = "value", partition: str = "partition",
                   offset: str = "offset") -> DataFrame:
    """(value, partition, offset) -> (partition, offset, job_doc_id,
    correlation_id, error). ``value`` may be binary or string."""
    vtype = records.schema[value].dataType
    raw = F.col(value)
    text = raw.cast("string") if isinstance(vtype, T.BinaryType) else raw
    # Staged selects: each parsed value is computed once and then referenced
    # by name (Spark does not merge stages that would repeat costly work).
    c = F.col
    s1 = records.select(c(partition).cast("int").alias("partition"),
                        c(offset).cast("bigint").alias("offset"),
                        raw.isNull().alias("_null"), F.is_valid_utf8(text).alias("_utf8"),
                        text.alias("_text"))
    s2 = s1.select("partition", "offset", "_null", "_utf8",
                   F.when(c("_utf8"), F.try_parse_json("_text")).alias("_doc"))
    s3 = s2.select(
        "partition", "offset", "_null", "_utf8", c("_doc").isNull().alias("_bad_json"),
        F.schema_of_variant("_doc").alias("_doc_kind"),
        F.try_variant_get("_doc", "$.job_doc_id", "variant").alias("_jd"),
        F.try_variant_get("_doc", "$.id", "variant").alias("_alias"),
        F.try_variant_get("_doc", "$.correlation_id", "variant").alias("_corr"))
    s4 = s3.select("*", F.schema_of_variant("_jd").alias("_jd_kind"),
                   F.schema_of_variant("_corr").alias("_corr_kind"))
    s5 = s4.select("*", F.when(is_truthy(c("_jd"), c("_jd_kind")), c("_jd"))
                   .otherwise(c("_alias")).alias("_chosen"))
    s6 = s5.select("*", F.schema_of_variant("_chosen").alias("_chosen_kind"),
                   F.try_variant_get("_chosen", "$", "string").alias("_chosen_text"))
    ok_object = F.coalesce(c("_doc_kind").startswith("OBJECT"), F.lit(False))
    ok_id = F.coalesce((c("_chosen_kind") == "STRING") & (c("_chosen_text") != ""), F.lit(False))
    ok_corr = c("_corr").isNull() | F.is_variant_null("_corr") | (c("_corr_kind") == "STRING")
    error = (F.when(c("_null"), F.lit(NULL_VALUE))
             .when(~c("_utf8") | c("_bad_json"), F.lit(UNDECODABLE))
             .when(~ok_object, F.lit(NOT_AN_OBJECT))
             .when(~ok_id, F.lit(MISSING_JOB_DOC_ID))
             .when(~F.coalesce(ok_corr, F.lit(False)), F.lit(BAD_CORRELATION_ID)))
    s7 = s6.select("partition", "offset", "_chosen_text", "_corr", error.alias("error"))
    s8 = s7.select(
        "partition", "offset",
        F.when(c("error").isNull(), c("_chosen_text")).alias("job_doc_id"),
        F.when(c("error").isNull(), F.try_variant_get("_corr", "$", "string")).alias("correlation_id"),
        "error")
    return barrier(s8, ["partition", "offset"], ["job_doc_id", "correlation_id", "error"])


def split_control(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable records, rejects) — rejects go to the dead-letter table."""
    return decoded.where(F.col("error").isNull()), decoded.where(F.col("error").isNotNull())
