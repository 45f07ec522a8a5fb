"""long value lists of ``terms`` and ``ids`` clauses, as tables.

A million values as literals make a plan of that size, and each row meets all of
them. Here the list is a table:

1. its least and greatest value bound the field, a range that reaches the scan;
2. a Bloom filter, built by an aggregate whose words combine in the tasks, is
   tested on rows where they are scanned, before any of them is shuffled;
3. rows that pass are joined with the list (left semi join), which decides.

A negated list keeps the rows that fail 1 or 2 where they are; only the others
meet the list in an anti join. The filter grows with the list up to ``MAX_BITS``
(8 MB); a longer list is joined without one.

Defined cases: nulls in a list, and values that the field's type can't hold,
match nothing; a null field matches no list and every negated one; repeated
values count once; an empty list matches nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.operators.predicates import QueryError, _coerce, _NoMatch
from docferry.sources.documents import DocumentView

#: Lists with more literals than this become tables.
LITERALS = 10_000
BITS_PER_VALUE = 10  # four places a value: about 1 % of other values pass
MAX_BITS = 1 << 26
_LISTED = "__listed"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Types whose equal values have equal hashes.
_HASHED = (*_WHOLE, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _places(value: Column, bits: int) -> list[Column]:
    """Four places of a value in a filter of ``bits``, a power of two."""
    mask = F.lit(bits - 1).cast("long")
    hashes = [F.xxhash64(F.lit(seed), value) for seed in (0, 1)]
    return [part.bitwiseAND(mask) for h in hashes for part in (h, F.shiftrightunsigned(h, 32))]


def bloom_words(values: DataFrame, bits: int) -> DataFrame:
    """The filter of ``value`` as one row: an array of ``bits`` / 64 words."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    filled = values.select(F.explode(F.array(*_places(F.col("value"), bits))).alias("p")) \
        .select(F.shiftright("p", 6).alias("w"), bit.alias("b"))
    empty = values.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    words = filled.unionByName(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words"))


def may_hold(words: Column, value: Column, bits: int) -> Column:
    """Whether the filter has all places of the value."""
    return reduce(Column.__and__, [
        F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        for p in _places(value, bits)])


def among(df: DataFrame, column: str, values: DataFrame, *, keep: bool = True,
          bits_per_value: int = BITS_PER_VALUE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``values`` (its first column), or
    with ``keep=False`` those whose isn't."""
    dtype = df.schema[column].dataType
    listed = values.select(F.col(f"`{values.columns[0]}`").try_cast(dtype).alias("value")).filter("value IS NOT NULL")
    n, low, high = listed.agg(F.count(F.lit(1)), F.min("value"), F.max("value")).first()
    if not n:
        return df.where(F.lit(False)) if keep else df
    col = F.col(f"`{column}`")
    maybe = col.isNotNull() & (col >= F.lit(low)) & (col <= F.lit(high))
    bits = 1 << max(10, (n * bits_per_value - 1).bit_length())
    if bits <= max_bits and isinstance(dtype, _HASHED):
        maybe = maybe & may_hold(bloom_words(listed, bits).scalar(), col, bits)
    other = listed.select(F.col("value").alias(_LISTED))
    if keep:
        return df.where(maybe).join(other, col == F.col(_LISTED), "left_semi")
    unlisted = df.where(maybe).join(other, col == F.col(_LISTED), "left_anti")
    return df.where(~F.coalesce(maybe, F.lit(False))).union(unlisted)


def literal_list(spark: SparkSession, values: list, dtype: T.DataType) -> DataFrame:
    """Literals as a table of the field's type (whole numbers or text)."""
    held = []
    for v in values:
        if not isinstance(v, (bool, int, float, str)):
            raise QueryError(f"unsupported value {v!r}")
        try:
            c = _coerce(v, dtype)
        except _NoMatch:
            continue
        if isinstance(dtype, T.StringType) or isinstance(c, int) and -(1 << 63) <= c < 1 << 63:
            held.append((c,))
    kind = "string" if isinstance(dtype, T.StringType) else "long"
    return spark.createDataFrame(held, f"value {kind}")


def _list_of(clause: str, body: Any, view: DocumentView) -> tuple[str, Any] | None:
    """(column, values) of a clause on a plain column of the table."""
    if not isinstance(body, Mapping):
        return None
    if clause == "ids":
        column, values = view.id_column, body.get("values", body if "index" in body else None)
    else:
        fields = {k: v for k, v in body.items() if k not in ("boost", "_name")}
        if len(fields) != 1:
            return None
        (column, values), = fields.items()
    if column not in view.root.columns or "." in column or "[" in column:
        return None
    return column, values


def take_lists(query: Any, view: DocumentView, tables: Callable[[str], DataFrame] | None = None
               ) -> tuple[Any, list[tuple[str, DataFrame, bool]]]:
    """The query without the long lists that all its documents must be in, or
    mustn't be in: (rest, [(column, values, keep)]). A list is long with more
    than ``LITERALS`` literals, or a table: ``{"index": name, "path": column}``
    in place of the values, which ``tables`` knows by name. Lists elsewhere in
    the query stay where they are."""
    found: list[tuple[str, DataFrame, bool]] = []

    def take(clause: Any, keep: bool) -> bool:
        if not isinstance(clause, Mapping) or len(clause) != 1 or next(iter(clause)) not in ("terms", "ids"):
            return False
        (kind, body), = clause.items()
        held = _list_of(kind, body, view)
        if held is None:
            return False
        column, values = held
        dtype = view.root.schema[column].dataType
        if isinstance(values, Mapping) and tables is not None and {"index", "path"} <= set(values):
            rows = tables(values["index"])
            if values["path"] not in rows.columns:
                raise QueryError(f"no column {values['path']!r} in {values['index']!r}")
            found.append((column, rows.select(F.col(f"`{values['path']}`")), keep))
        elif isinstance(values, list) and len(values) > LITERALS and isinstance(dtype, (*_WHOLE, T.StringType)):
            found.append((column, literal_list(view.root.sparkSession, values, dtype), keep))
        else:
            return False
        return True

    if view.variant_root is not None or not isinstance(query, Mapping) or len(query) != 1:
        return query, found
    if take(query, True):
        return {"match_all": {}}, found
    (clause, body), = query.items()
    if clause != "bool" or not isinstance(body, Mapping):
        return query, found
    rest = dict(body)
    for key, keep in (("must", True), ("filter", True), ("must_not", False)):
        if key in body:
            items = body[key] if isinstance(body[key], list) else [body[key]]
            # A clause that holds for all rows stays: ``should`` depends on there being one.
            left = [({"match_all": {}} if keep else None) if take(q, keep) else q for q in items]
            rest[key] = [q for q in left if q is not None]
    return ({"bool": rest} if found else query), found
