"""Many jobs over one table by an index of their queries.

Jobs are rows, not expressions: a plan has the same size for ten jobs and for
ten thousand. Each query becomes alternatives of simple tests (its disjunctive
normal form); of an alternative's tests two at most give its *access keys*, one of
values and one of a range or prefix, and a key is made of both:

* ``term`` / ``terms``: a key for each value (an inverted index);
* ``range``: the bounds of all such jobs cut the field's values into elementary
  intervals, and a range is a few nodes of the binary tree over them (an
  interval index); a value's keys are its interval's ancestors in the levels
  that some range uses;
* ``prefix``: the prefix; a value's keys are its beginnings of the lengths that
  some job uses;
* none: one key that every row has.

Rows are joined with the index on their keys, so a row meets only jobs whose
access tests it passes; the alternative's other tests are data, too, and are
evaluated by one expression over the row's values. An alternative also carries
the job's earlier ones and counts only where none of those matches, so a row
meets a job once, without a shuffle.

Where only a number, least and greatest value are wanted for each job (``tag``
with ``summary``), rows aren't paired with jobs: those with the same key and
the same values in the fields that are still to be tested are summed up first,
and the sums are joined with the index. There, jobs of few alternatives are
counted by inclusion and exclusion: each set of alternatives is an entry of its
own with a sign, so an entry needs no field of other alternatives.

Supported: ``match_all``, ``term``, ``terms``, ``range``, ``exists``, ``prefix``
and ``bool`` over top-level columns of text, integer, boolean, floating-point,
date and timestamp type, with the rules of ``predicates`` (missing fields match
only negated clauses). ``unsupported`` lists the jobs outside of that; they are
for ``scan.tag_jobs``.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone
from itertools import combinations
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.operators.predicates import (
    QueryError, _coerce, _date_bound, _field_and_body, _is_date_type, _NoMatch, _value_of, _zone, resolve_date_math)
from docferry.operators.scan import JOB_TAG

#: Alternatives that a query may have; more are left to ``tag_jobs``.
MOST_ALTERNATIVES = 64
#: Alternatives whose sets are entries of their own for sums (2^n - 1 sets).
MOST_SIGNED = 3
#: Values of a test that a range or prefix is combined with; more stand alone.
MOST_COMBINED = 16

TEST = ("struct<field:int,kind:string,neg:boolean,ss:array<string>,ls:array<bigint>,ds:array<double>,"
        "los:string,his:string,lol:bigint,hil:bigint,lod:double,hid:double,lo_open:boolean,hi_open:boolean>")
COMPILED = (f"job_id string, problem string, use string, sign int, vfield int, access string, field int, key string, los string, his string, "
            f"lol bigint, hil bigint, lod double, hid double, lo_open boolean, hi_open boolean, "
            f"tests array<{TEST}>, earlier array<array<{TEST}>>")


class Unsupported(Exception):
    """The query is outside of what the index can hold."""


class Field(NamedTuple):
    no: int
    kind: str  # s, l or d: text, whole number, floating point
    dtype: T.DataType


def fields_of(schema: T.StructType) -> dict[str, Field]:
    """Columns that the index can test."""
    out = {}
    for no, f in enumerate(schema.fields):
        if isinstance(f.dataType, T.StringType):
            kind = "s"
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType,
                                     T.TimestampType, T.TimestampNTZType)):
            kind = "l"
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            kind = "d"
        else:
            continue
        out[f.name] = Field(no, kind, f.dataType)
    return out


def _number(v: Any, dt: T.DataType) -> Any:
    """A date or time as the whole number that ``_values`` has for it."""
    if isinstance(v, datetime):
        n = (v - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        return n // 86_400_000_000 if isinstance(dt, T.DateType) else n
    return int(v) if isinstance(v, bool) else v


def _bound(value: Any, f: Field, now: datetime, *, round_up: bool = False, zone=timezone.utc,
           fmt: str | None = None) -> Any:
    if _is_date_type(f.dtype):
        value = _date_bound(value, fmt)
        if isinstance(value, str):
            return _number(resolve_date_math(value, now, round_up=round_up, zone=zone), f.dtype)
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return _number(datetime(1970, 1, 1) + timedelta(milliseconds=value), f.dtype)
        raise QueryError(f"unsupported date bound {value!r}")
    if not isinstance(value, (bool, int, float, str)):
        raise QueryError(f"unsupported value {value!r}")
    return _number(_coerce(value, f.dtype), f.dtype)


def _test(f: Field, kind: str, **more: Any) -> dict:
    return {"field": f.no, "kind": kind, "neg": False, **more}


_LONG = (-(1 << 63), (1 << 63) - 1)


def _leaf(clause: str, body: Any, fields: Mapping[str, Field], now: datetime) -> dict | bool:
    """One test, or a constant."""
    def field(name: Any) -> Field:
        if name not in fields:
            raise Unsupported(f"field {name!r}")
        return fields[name]

    if clause == "exists":
        if not isinstance(body, Mapping) or "field" not in body:
            raise QueryError("exists needs a field")
        return _test(field(body["field"]), "exists")
    name, spec = _field_and_body(clause, body)
    f = field(name)
    if clause in ("term", "terms"):
        values = [_value_of(spec)] if clause == "term" else spec
        if not isinstance(values, list):
            raise QueryError("terms needs a list of values")
        found = []
        for v in values:
            try:
                if _is_date_type(f.dtype):
                    raise Unsupported("term on a date")
                v = _bound(v, f, now)
                if f.kind == "l" and (isinstance(v, float) or not _LONG[0] <= v <= _LONG[1]):
                    continue
                found.append(float(v) if f.kind == "d" else v)
            except _NoMatch:
                continue
        return _test(f, "in", **{f.kind + "s": sorted(set(found))}) if found else False
    if clause == "prefix":
        value = _value_of(spec)
        if not isinstance(value, str):
            raise QueryError("prefix needs a string")
        if f.kind != "s":
            raise Unsupported("prefix of a number")
        return _test(f, "prefix", los=value)
    if clause == "range":
        if not isinstance(spec, Mapping):
            raise QueryError("range needs an object of bounds")
        known = {"gte", "gt", "lte", "lt"}
        if set(spec) - known - {"format", "time_zone", "boost", "_name"} or not set(spec) & known:
            raise QueryError("bad range")
        if not _is_date_type(f.dtype) and (spec.get("format") or spec.get("time_zone")):
            raise QueryError("format and time_zone need a date field")
        zone = _zone(spec["time_zone"]) if spec.get("time_zone") is not None else timezone.utc
        if isinstance(f.dtype, T.DateType):
            raise Unsupported("range on days")  # bounds between days need the time
        lo = hi = None
        lo_open = hi_open = False
        try:
            for key in sorted(set(spec) & known):
                v = _bound(spec[key], f, now, round_up=key in ("gt", "lte"), zone=zone, fmt=spec.get("format"))
                if f.kind == "l":  # closed bounds of whole numbers
                    v = {"gte": math.ceil(v), "gt": math.floor(v) + 1, "lte": math.floor(v), "lt": math.ceil(v) - 1}[key]
                if key in ("gte", "gt"):
                    if lo is None or v > lo or v == lo and key == "gt":
                        lo, lo_open = v, key == "gt" and f.kind != "l"
                elif hi is None or v < hi or v == hi and key == "lt":
                    hi, hi_open = v, key == "lt" and f.kind != "l"
        except _NoMatch:
            return False
        if f.kind == "l":
            lo = _LONG[0] if lo is None else lo
            hi = _LONG[1] if hi is None else hi
            if lo > _LONG[1] or hi < _LONG[0] or lo > hi:
                return False
            lo, hi = max(lo, _LONG[0]), min(hi, _LONG[1])
        elif lo is not None and hi is not None and (lo > hi or lo == hi and (lo_open or hi_open)):
            return False
        return _test(f, "range", lo_open=lo_open, hi_open=hi_open, **{f"lo{f.kind}": lo, f"hi{f.kind}": hi})
    raise Unsupported(clause)


def alternatives(query: Any, fields: Mapping[str, Field], now: datetime, negate: bool = False) -> list[list[dict]]:
    """The query as alternatives, each a list of tests that must all hold."""
    if not isinstance(query, Mapping) or len(query) != 1:
        raise QueryError("query must hold exactly one clause")
    (clause, body), = query.items()
    if clause == "match_all":
        return [] if negate else [[]]
    if clause != "bool":
        t = _leaf(clause, body, fields, now)
        if isinstance(t, bool):
            return [[]] if t != negate else []
        return [[{**t, "neg": negate}]]
    if not isinstance(body, Mapping):
        raise QueryError("bool must be an object")
    if set(body) - {"must", "filter", "should", "must_not", "minimum_should_match", "boost", "_name"}:
        raise QueryError("unknown bool keys")

    def of(key: str) -> list:
        v = body.get(key, [])
        return v if isinstance(v, list) else [v]

    must, should, must_not = of("must") + of("filter"), of("should"), of("must_not")
    least = body.get("minimum_should_match", 0 if must else 1)
    if least not in (0, 1):
        raise Unsupported("minimum_should_match")
    # All of these must hold: each a list of alternatives.
    needed = [alternatives(q, fields, now, False) for q in must] + [alternatives(q, fields, now, True) for q in must_not]
    if should and least:
        needed.append([a for q in should for a in alternatives(q, fields, now, False)])
    if negate:
        # Any of them fails.
        out = [a for q in must for a in alternatives(q, fields, now, True)]
        out += [a for q in must_not for a in alternatives(q, fields, now, False)]
        if should and least:
            none = [[]]
            for q in should:
                none = _both(none, alternatives(q, fields, now, True))
            out += none
        return _few(out)
    out = [[]]
    for n in needed:
        out = _both(out, n)
    return out


def _few(found: list) -> list:
    if len(found) > MOST_ALTERNATIVES:
        raise Unsupported("too many alternatives")
    return found


def _both(a: list[list[dict]], b: list[list[dict]]) -> list[list[dict]]:
    if len(a) * len(b) > MOST_ALTERNATIVES:
        raise Unsupported("too many alternatives")
    return [x + y for x in a for y in b]


def _access(tests: list[dict]) -> tuple[int | None, int | None]:
    """Places of the tests that find the alternative: one of values, and a range
    with two bounds or a prefix, before a range with one. Long lists of values
    find it alone."""
    value, other, rank = None, None, 0
    for i, t in enumerate(tests):
        if t["neg"]:
            continue
        if t["kind"] == "in":
            value = i if value is None or len(_listed(t)) < len(_listed(tests[value])) else value
            continue
        both = sum(t.get(f"{end}{k}") is not None and t.get(f"{end}{k}") not in _LONG for end in ("lo", "hi") for k in "sld")
        r = 1 + both if t["kind"] == "range" else 3 if t["kind"] == "prefix" and t["los"] else 0
        if r > rank:
            other, rank = i, r
    if value is not None and len(_listed(tests[value])) > MOST_COMBINED:
        other = None
    return value, other


def _listed(test: dict) -> list:
    return test.get("ss") or test.get("ls") or test.get("ds")


def _signed(found: list[list[dict]]):
    """(use, sign, tests, earlier) of a query's alternatives: for ``rows`` each
    one without the earlier ones, for ``sums`` each set of them (``both``: for
    either)."""
    if len(found) > MOST_SIGNED:
        for n, tests in enumerate(found):
            yield "both", 1, tests, found[:n]
        return
    for n, tests in enumerate(found):
        yield "both" if not n else "rows", 1, tests, found[:n]
    for size in range(1, len(found) + 1):
        for some in combinations(range(len(found)), size):
            if some != (0,):
                every = [t for n in some for t in found[n]]
                yield "sums", 1 if size % 2 else -1, [t for i, t in enumerate(every) if t not in every[:i]], []


def _spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all tasks: a table of a few MB, which Spark reads in one
    task, can hold jobs or rows that take minutes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def compile_jobs(jobs: DataFrame, schema: T.StructType, now: datetime) -> DataFrame:
    """``COMPILED`` rows of jobs (job_id, query: JSON text); a row with a
    ``problem`` for each job that the index can't hold."""
    fields = fields_of(schema)
    names = [c.split()[0] for c in COMPILED.replace(f"array<array<{TEST}>>", "x").replace(f"array<{TEST}>", "x").split(", ")]
    arrow_test = pa.struct([
        ("field", pa.int32()), ("kind", pa.string()), ("neg", pa.bool_()), ("ss", pa.list_(pa.string())),
        ("ls", pa.list_(pa.int64())), ("ds", pa.list_(pa.float64())), ("los", pa.string()), ("his", pa.string()),
        ("lol", pa.int64()), ("hil", pa.int64()), ("lod", pa.float64()), ("hid", pa.float64()),
        ("lo_open", pa.bool_()), ("hi_open", pa.bool_())])
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(),
             pa.float64(), pa.float64(), pa.bool_(), pa.bool_(), pa.list_(arrow_test), pa.list_(pa.list_(arrow_test))]
    limits = ("los", "his", "lol", "hil", "lod", "hid", "lo_open", "hi_open")

    def rows_of(job_id: str, query: str):
        try:
            found = alternatives(json.loads(query) if query else None, fields, now)
        except (Unsupported, QueryError, ValueError) as e:
            yield {"job_id": job_id, "problem": str(e) or type(e).__name__}
            return
        for use, sign, tests, earlier in _signed(found):
            value, other = _access(tests)
            rest = [t for i, t in enumerate(tests) if i not in (value, other)]
            base = {"job_id": job_id, "use": use, "sign": sign, "tests": rest, "earlier": earlier, "access": "none"}
            if other is not None:
                t = tests[other]
                base |= {"access": t["kind"], "field": t["field"], **{k: t.get(k) for k in limits}}
            if value is None:
                yield {**base, "key": ""}
                continue
            t = tests[value]
            for v in _listed(t):
                yield {**base, "vfield": t["field"], "key": f"={t['field']}={_key_text(v)}"}

    def run(batches):
        for batch in batches:
            rows = [r for job_id, q in zip(*[batch.column(k).to_pylist() for k in (0, 1)], strict=True)
                    for r in rows_of(job_id, q)]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k)
                                              for n, k in zip(names, kinds, strict=True)], names=names)

    return _spread(jobs.select(F.col("job_id").cast("string"), F.col("query").cast("string"))).mapInArrow(run, COMPILED)


def _key_text(v: Any) -> str:
    """Text of a value in a key; ``_value_key`` writes the same."""
    return (v + 0.0).hex() if isinstance(v, float) else str(v)


def _value_key(kind: str, no: int, v: Column) -> Column:
    if kind == "d":  # few jobs: floating-point terms go through Python
        @F.pandas_udf("string")
        def text(s: pd.Series) -> pd.Series:
            return pd.Series([(x + 0.0).hex() for x in s.tolist()], dtype=object)

        return F.when(v.isNotNull(), F.concat(F.lit(f"={no}="), text(F.coalesce(v, F.lit(0.0)))))
    return F.concat(F.lit(f"={no}="), v.cast("string"))


def _values(df: DataFrame, fields: Mapping[str, Field]) -> dict[str, Column]:
    """Each field as text, whole number or floating point."""
    out = {}
    for name, f in fields.items():
        c = F.col(f"`{name}`")
        if isinstance(f.dtype, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dtype, T.TimestampNTZType):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dtype, T.DateType):
            c = F.unix_date(c).cast("bigint")
        else:
            c = c.cast({"s": "string", "l": "bigint", "d": "double"}[f.kind])
        out[name] = c
    return out


def _nodes(low: int, high: int) -> list[tuple[int, int]]:
    """(level, node) of the binary tree's nodes that make up [low, high]."""
    out, level = [], 0
    while low <= high:
        if low & 1:
            out.append((level, low))
            low += 1
        if not high & 1:
            out.append((level, high))
            high -= 1
        low, high, level = low >> 1, high >> 1, level + 1
    return out


class Shape(NamedTuple):
    """Entries that are found by the same fields: ``parts`` are the levels of
    their ranges' nodes or the lengths of their prefixes, ``rest`` the fields
    that their tests read besides."""

    use: str
    vfield: int | None
    access: str
    field: int | None
    parts: tuple[int, ...]
    rest: frozenset[int]


class JobIndex(NamedTuple):
    """``entries``: (key, job_id, use, sign, tests, earlier); ``cuts``: by range
    field its sorted bounds, of which every job gives two at most."""

    entries: DataFrame
    unsupported: DataFrame
    fields: dict[str, Field]
    shapes: list[Shape]
    cuts: dict[str, list]


def build(jobs: DataFrame, schema: T.StructType, now: datetime, path: str) -> JobIndex:
    """Index jobs (job_id, query) over rows of ``schema``; written to ``path``."""
    spark = jobs.sparkSession
    fields = fields_of(schema)
    by_no = {f.no: name for name, f in fields.items()}
    compile_jobs(jobs, schema, now).write.mode("overwrite").parquet(f"{path}/compiled")
    compiled = spark.read.schema(COMPILED).parquet(f"{path}/compiled")
    good = compiled.filter("problem IS NULL")
    ranges = good.filter("access = 'range'")
    cuts: dict[str, list] = {}
    for r in ranges.select("field").distinct().collect():
        name = by_no[r.field]
        k = fields[name].kind
        bounds = ranges.filter(F.col("field") == r.field).select(F.explode(F.array(f"lo{k}", f"hi{k}")).alias("b"))
        cuts[name] = [x.b for x in bounds.filter("b IS NOT NULL").distinct().orderBy("b").collect()]
    shared = spark.sparkContext.broadcast({fields[n].no: (fields[n].kind, c) for n, c in cuts.items()})

    @F.udf("array<struct<part:int,key:string>>")
    def node_keys(no, los, his, lol, hil, lod, hid, lo_open, hi_open):
        if no not in shared.value:
            return None
        kind, bounds = shared.value[no]

        def place(v):
            at = bisect_left(bounds, v)
            return 2 * at + 1 if at < len(bounds) and bounds[at] == v else 2 * at

        low, high = {"s": (los, his), "l": (lol, hil), "d": (lod, hid)}[kind]
        first = 0 if low is None else place(low) + bool(lo_open)
        last = 2 * len(bounds) if high is None else place(high) - bool(hi_open)
        return [(level, f"~{no}~{level}~{node}") for level, node in _nodes(first, last)]

    def one(part: Column, key: Column) -> Column:
        return F.array(F.struct(part.cast("int").alias("part"), key.alias("key")))

    start = F.concat(F.lit("^"), F.col("field").cast("string"), F.lit("^"), F.length("los").cast("string"), F.lit("^"), F.col("los"))
    keys = F.when(F.col("access") == "range", node_keys(
        "field", "los", "his", "lol", "hil", "lod", "hid", "lo_open", "hi_open")) \
        .when(F.col("access") == "prefix", one(F.length("los"), start)).otherwise(one(F.lit(0), F.lit("")))
    keyed = good.withColumn("found", F.explode(keys)).withColumn("part", F.col("found.part")) \
        .withColumn("key", F.concat(F.col("found.key"), F.col("key")))
    shape = ("use", "vfield", "access", "field")
    keyed.select("key", "job_id", "sign", "tests", "earlier", "part", *shape).write.mode("overwrite").parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    read = F.array_distinct(F.transform(F.concat("tests", F.flatten("earlier")), lambda t: t["field"]))
    parts = entries.groupBy(*shape).agg(F.collect_set("part").alias("parts"))
    rest = entries.select(*shape, F.explode(read).alias("f")).groupBy(*shape).agg(F.collect_set("f").alias("rest"))
    tested = {(r.use, r.vfield, r.access, r.field): frozenset(r.rest) for r in rest.collect()}
    shapes = [Shape(r.use, r.vfield, r.access, r.field, tuple(sorted(r.parts)),
                    tested.get((r.use, r.vfield, r.access, r.field), frozenset())) for r in parts.collect()]
    return JobIndex(entries.select("key", "job_id", "use", "sign", "tests", "earlier"),
                    compiled.filter("problem IS NOT NULL").select("job_id", "problem"), fields,
                    sorted(shapes, key=repr), cuts)


def _holds(test: Column, value: Column) -> Column:
    """One test on its field's value (a struct of s, l and d)."""
    there = value["s"].isNotNull() | value["l"].isNotNull() | value["d"].isNotNull()

    def within(k: str) -> Column:
        v, lo, hi = value[k], test[f"lo{k}"], test[f"hi{k}"]
        return (v.isNotNull() & (lo.isNull() | (v > lo) | ((v == lo) & ~test["lo_open"]))
                & (hi.isNull() | (v < hi) | ((v == hi) & ~test["hi_open"])))

    def among(k: str) -> Column:
        return value[k].isNotNull() & test[f"{k}s"].isNotNull() & F.array_contains(test[f"{k}s"], value[k])

    ok = F.when(test["kind"] == "exists", there) \
        .when(test["kind"] == "prefix", value["s"].startswith(test["los"])) \
        .when(test["kind"] == "in", among("s") | among("l") | among("d")) \
        .otherwise(within("s") | within("l") | within("d"))
    return F.coalesce(ok, F.lit(False)) != test["neg"]


def _interval(spark: SparkSession, bounds: list, kind: str):
    """UDF: the elementary interval of a value. They are, in order: below the
    first bound, the first bound itself, between it and the second, and so on."""
    dtype = {"s": object, "l": np.int64, "d": np.float64}[kind]
    shared = spark.sparkContext.broadcast(np.array(bounds, dtype=dtype))

    @F.pandas_udf("bigint")
    def interval(s: pd.Series) -> pd.Series:
        cuts, v = shared.value, s.to_numpy(dtype=dtype)
        at = np.searchsorted(cuts, v, "left").astype(np.int64)
        inside = at < len(cuts)
        hit = np.zeros(len(v), bool)
        hit[inside] = cuts[at[inside]] == v[inside]
        return pd.Series(2 * at + hit)

    return interval


def _placed(df: DataFrame, index: JobIndex) -> DataFrame:
    """``df`` with the elementary intervals of its range fields."""
    values = _values(df, index.fields)
    for name, bounds in index.cuts.items():
        f = index.fields[name]
        none = {"s": "", "l": 0, "d": 0.0}[f.kind]
        interval = _interval(df.sparkSession, bounds, f.kind)
        place = F.when(values[name].isNotNull(), interval(F.coalesce(values[name], F.lit(none))))
        df = df.withColumn(f"__place_{f.no}", place)
    return df


def _keys(shape: Shape, index: JobIndex, values: dict[str, Column]) -> list[Column]:
    """Keys of a row of ``_placed`` for the entries of a shape; null: none."""
    by_no = {f.no: name for name, f in index.fields.items()}
    value = F.lit("")
    if shape.vfield is not None:
        name = by_no[shape.vfield]
        value = _value_key(index.fields[name].kind, shape.vfield, values[name])
    no = shape.field
    if shape.access == "range":
        found = [F.concat(F.lit(f"~{no}~{k}~"), F.shiftright(F.col(f"__place_{no}"), k).cast("string")) for k in shape.parts]
    elif shape.access == "prefix":
        v = values[by_no[no]]
        found = [F.when(F.length(v) >= n, F.concat(F.lit(f"^{no}^{n}^"), F.left(v, F.lit(n)))) for n in shape.parts]
    else:
        found = [F.lit("")]
    return [F.concat(k, value) for k in found]


def _own(nos: list[int], index: JobIndex, values: dict[str, Column], only=None) -> Column:
    """Values of the fields ``nos``, each a struct of s, l and d; null for those
    that aren't in ``only``."""
    by_no = {f.no: name for name, f in index.fields.items()}
    return F.array(*[F.struct(*[
        (values[by_no[no]] if index.fields[by_no[no]].kind == k and (only is None or no in only) else F.lit(None)).cast(t).alias(k)
        for k, t in (("s", "string"), ("l", "bigint"), ("d", "double"))]) for no in nos])


def _passed(met: DataFrame, nos: list[int]) -> DataFrame:
    """Rows whose values (``__own``, of the fields ``nos``) pass the tests and
    no earlier alternative's."""
    if not nos:
        # No tests beside access keys; an earlier alternative holds where it is empty.
        return met.filter(F.size("earlier") == 0)
    met = met.withColumn("__own", F.map_from_arrays(F.array(*[F.lit(no) for no in nos]), "__own"))

    def all_hold(tests: Column) -> Column:
        return F.forall(tests, lambda t: _holds(t, F.col("__own")[t["field"]]))

    return met.filter(all_hold(F.col("tests")) & ~F.exists("earlier", all_hold))


def _entries(index: JobIndex, use: str) -> tuple[DataFrame, list[Shape], list[int]]:
    """Entries for a use, their shapes and the fields that they test."""
    shapes = [s for s in index.shapes if s.use in ("both", use)]
    entries = index.entries.filter(F.col("use").isin("both", use)).drop("use") \
        .withColumnRenamed("key", "__key").withColumnRenamed("job_id", JOB_TAG)
    return entries, shapes, sorted({no for s in shapes for no in s.rest})


def tag(df: DataFrame, index: JobIndex, summary: str | None = None) -> DataFrame:
    """``df`` with a row for each job that matches (column ``JOB_TAG``). With a
    column's name as ``summary`` a row for each job that matches any: ``JOB_TAG``,
    the number of rows ``n`` and the column's least and greatest value in them
    (``first``, ``last``)."""
    if summary is not None:
        return _sums(df, index, summary)
    values = _values(df, index.fields)
    entries, shapes, nos = _entries(index, "rows")
    # Shapes of both uses may have the same keys; a row has each key once.
    keys = F.array_distinct(F.array(*[k for s in shapes for k in _keys(s, index, values)], F.lit(None).cast("string")))
    rows = _placed(df, index).withColumn("__key", F.explode(F.filter(keys, lambda k: k.isNotNull())))
    # Spark broadcasts the index where it is small and shuffles both beyond.
    met = rows.join(entries, "__key")
    if nos:
        met = met.withColumn("__own", _own(nos, index, values))
    return _passed(met, nos).drop("__key", "__own", "sign", "tests", "earlier",
                                  *[f"__place_{index.fields[n].no}" for n in index.cuts])


def _sums(df: DataFrame, index: JobIndex, column: str) -> DataFrame:
    values = _values(df, index.fields)
    entries, shapes, nos = _entries(index, "sums")
    # Shapes that are found by the same fields share their sums.
    alike: dict[tuple, tuple[set[int], set[int]]] = {}
    for s in shapes:
        parts, rest = alike.setdefault((s.vfield, s.access, s.field), (set(), set()))
        parts.update(s.parts)
        rest.update(s.rest)
    found = []
    for (vfield, access, field), (parts, rest) in alike.items():
        own = _own(nos, index, values, rest) if nos else F.lit(None).cast("array<struct<s:string,l:bigint,d:double>>")
        shape = Shape("sums", vfield, access, field, tuple(sorted(parts)), frozenset(rest))
        found += [F.struct(k.alias("key"), own.alias("own")) for k in _keys(shape, index, values)]
    of = F.col(f"`{column}`")
    if not found:
        return df.select(F.lit(None).cast("string").alias(JOB_TAG), F.lit(0).cast("bigint").alias("n"), of.alias("first"),
                         of.alias("last")).limit(0)
    rows = _placed(_spread(df), index).select(of.alias("__of"), F.explode(F.array(*found)).alias("e")).filter("e.key IS NOT NULL")
    sums = rows.groupBy(F.col("e.key").alias("__key"), F.col("e.own").alias("__own")).agg(
        F.count(F.lit(1)).alias("n"), F.min("__of").alias("first"), F.max("__of").alias("last"))
    met = _passed(sums.join(entries, "__key"), nos)
    plus = F.col("sign") > 0
    return met.groupBy(JOB_TAG).agg(
        F.sum(F.col("sign") * F.col("n")).alias("n"), F.min(F.when(plus, F.col("first"))).alias("first"),
        F.max(F.when(plus, F.col("last"))).alias("last")).filter("n > 0")
