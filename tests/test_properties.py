"""Property tests: CSV records and float text against Python, on random batches."""

from __future__ import annotations

import csv
import io
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.functions.render import csv_line, py_float_text

CELL = st.text(alphabet=st.sampled_from(list('ab ,"\r\n\t\\#=é😀')), max_size=8)
ROWS = st.lists(st.tuples(CELL, CELL, CELL), min_size=1, max_size=300)
FLOATS = st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=300)


def _py(values):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerow(values)
    return buf.getvalue()[:-1]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_csv_records_match_python(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    got = dict(df.select("i", csv_line([F.col("a"), F.col("b"), F.col("c")])).collect())
    one = dict(df.select("i", csv_line([F.col("a")])).collect())
    for i, r in enumerate(rows):
        assert got[i] == _py(list(r)), r
        assert one[i] == _py([r[0]]), r[0]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(FLOATS)
def test_float_text_matches_repr(spark, values):
    values = [v for v in values if v == 0 or abs(v) >= 2.3e-308]  # subnormals: JVM prints more digits
    if not values:
        return
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = dict(df.select("i", py_float_text(F.col("v"))).collect())
    for i, v in enumerate(values):
        assert got[i] == repr(v) or (math.isnan(v) and got[i] == "nan"), v


# ---------------------------------------------------------------------------
# Job queries against a brute-force evaluator on a small fixture.
# ---------------------------------------------------------------------------

DOCS = [
    {"id": 1, "s": "apple", "n": 5, "tags": ["x", "y"], "u": {"name": "ann"},
     "it": [{"k": "x", "q": 3}, {"k": "ap", "q": 9}]},
    {"id": 2, "s": "banana", "n": None, "tags": [], "u": {"name": None}, "it": []},
    {"id": 3, "s": None, "n": 12, "tags": None, "u": None, "it": None},
    {"id": 4, "s": "apricot", "n": -3, "tags": ["y"], "u": {"name": "bob"},
     "it": [{"k": None, "q": None}]},
    {"id": 5, "s": "", "n": 0, "tags": ["z"], "u": {"name": "ann"}, "it": [{"k": "z", "q": 0}]},
    {"id": 6, "s": "cherry", "n": 7, "tags": ["x"], "u": {"name": "cy"},
     "it": [{"k": "y", "q": 12}, {"k": "x", "q": -4}]},
]
FIELDS = {"s": "str", "n": "int", "tags": "list", "u.name": "str", "it.k": "list", "it.q": "intlist"}


def _get(doc, field):
    """Field value; through a list of objects, the list of their values."""
    cur = doc
    for part in field.split("."):
        if isinstance(cur, list):
            cur = [e.get(part) for e in cur if isinstance(e, dict)]
            continue
        if not isinstance(cur, dict) or cur.get(part) is None:
            return None
        cur = cur[part]
    return cur


def _eval(q, doc):
    (clause, body), = q.items()
    if clause == "term":
        (f, v), = body.items()
        x = _get(doc, f)
        return x is not None and (v in x if isinstance(x, list) else x == v)
    if clause == "terms":
        (f, vs), = body.items()
        x = _get(doc, f)
        return x is not None and (any(v in x for v in vs) if isinstance(x, list) else x in vs)
    if clause == "range":
        (f, b), = body.items()
        x = _get(doc, f)
        if x is None:
            return False
        values = [v for v in x if v is not None] if isinstance(x, list) else [x]
        ops = {"gte": "__ge__", "gt": "__gt__", "lte": "__le__", "lt": "__lt__"}
        return any(all(getattr(y, ops[k])(v) for k, v in b.items()) for y in values)
    if clause == "prefix":
        (f, v), = body.items()
        x = _get(doc, f)
        if isinstance(x, list):
            return any(e is not None and e.startswith(v) for e in x)
        return x is not None and x.startswith(v)
    if clause == "exists":
        x = _get(doc, body["field"])
        return x is not None and (any(v is not None for v in x) if isinstance(x, list) else True)
    must = [_eval(c, doc) for c in body.get("must", []) + body.get("filter", [])]
    should = [_eval(c, doc) for c in body.get("should", [])]
    must_not = [_eval(c, doc) for c in body.get("must_not", [])]
    msm = body.get("minimum_should_match", 0 if must else 1)
    return all(must) and (not should or msm == 0 or sum(should) >= msm) and not any(must_not)


def _leaf():
    strs = st.sampled_from(["apple", "banana", "", "ann", "x", "y", "z", "ap", "zzz"])
    ints = st.integers(min_value=-5, max_value=15)
    field = st.sampled_from(sorted(FIELDS) + ["missing", "u.missing"])

    def term(f):
        kind = FIELDS.get(f, "str")
        kind = "int" if kind == "intlist" else kind
        val = ints if kind == "int" else strs
        return st.one_of(
            val.map(lambda v: {"term": {f: v}}),
            st.lists(val, min_size=1, max_size=3).map(lambda vs: {"terms": {f: vs}}),
            st.just({"exists": {"field": f}}),
            (ints.flatmap(lambda a: st.sampled_from(["gte", "gt", "lte", "lt"])
                          .map(lambda op: {"range": {f: {op: a}}}))) if kind == "int"
            else strs.map(lambda p: {"prefix": {f: p}}))

    return field.flatmap(term)


QUERIES = st.recursive(
    _leaf(),
    lambda inner: st.fixed_dictionaries(
        {}, optional={"must": st.lists(inner, max_size=2), "should": st.lists(inner, max_size=3),
                      "must_not": st.lists(inner, max_size=2)}).map(lambda b: {"bool": b}),
    max_leaves=6)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(QUERIES, min_size=20, max_size=20))
def test_queries_match_brute_force(spark, queries):
    from datetime import datetime

    from docferry.operators.scan import count_per_job

    df = spark.createDataFrame(
        [(d["id"], d["s"], d["n"], d["tags"], d["u"],
          None if d["it"] is None else [(e["k"], e["q"]) for e in d["it"]]) for d in DOCS],
        "id int, s string, n int, tags array<string>, u struct<name: string>, "
        "it array<struct<k: string, q: int>>")
    jobs = [(f"q{i}", q) for i, q in enumerate(queries)]
    got = {r.job_id: r.source_count for r in count_per_job(df, jobs, now=datetime(2024, 1, 1)).collect()}
    for job_id, q in jobs:
        want = sum(1 for d in DOCS if _eval(q, d))
        assert got[job_id] == want, q


# ---------------------------------------------------------------------------
# Paths over schemaless documents against a walk over the Python objects.
# ---------------------------------------------------------------------------

KEYS = st.sampled_from(["a", "b", "c", "0", "k"])
JSONS = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-1000, 1000),
              st.text(alphabet="xyz ,\"é", max_size=4)),
    lambda inner: st.one_of(st.lists(inner, max_size=3),
                            st.dictionaries(KEYS, inner, max_size=3)),
    max_leaves=8)
DOCS_JSON = st.dictionaries(KEYS, JSONS, max_size=4)
STEP = st.one_of(KEYS, st.sampled_from(["[0]", "[1]", "[2]", "[x]", "[-1]"]))
PATHS = st.one_of(
    st.lists(STEP, min_size=1, max_size=4).map(lambda ss: ".".join(ss).replace(".[", "[")),
    st.sampled_from([".", "..", "a..b", "a.0", "a[0][0]"]))


def _walk(doc, path):
    from docferry.functions.paths import Index, tokenize

    steps = tokenize(path)
    if not steps:
        return None
    cur = doc
    for s in steps:
        if isinstance(s, Index):
            if not isinstance(cur, list) or s.pos >= len(cur):
                return None
            cur = cur[s.pos]
        else:
            if not isinstance(cur, dict) or s.name not in cur:
                return None
            cur = cur[s.name]
        if cur is None:
            return None
    return cur


def _same(got, want):
    import json

    if want is None:
        return got == ""
    if isinstance(want, bool):
        return got == ("true" if want else "false")
    if isinstance(want, (dict, list)):
        return json.loads(got) == want
    return got == str(want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DOCS_JSON, min_size=1, max_size=25), st.lists(PATHS, min_size=1, max_size=8, unique=True))
def test_paths_match_python_walk(spark, docs, paths):
    import json

    from docferry.operators.projection import project
    from docferry.sources.documents import json_string_documents

    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, doc string")
    view = json_string_documents(df, "doc", id_column="i")
    cols = [f"c{j}" for j in range(len(paths))]
    out = project(view, ["_id"] + cols, dict(zip(cols, paths))).collect()
    for row in out:
        doc = docs[int(row["_id"])]
        for c, p in zip(cols, paths):
            assert _same(row[c], _walk(doc, p)), (doc, p, row[c])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(max_size=10), st.one_of(st.none(), st.floats(width=64)),
                          st.lists(st.integers(-10**12, 10**12), max_size=3)),
                min_size=1, max_size=100))
def test_json_lines_match_json_dumps(spark, rows):
    import json

    from docferry.functions.render import json_line

    rows = [(s, f if f is None or f == 0 or abs(f) >= 2.3e-308 or f != f else 0.0, l) for s, f, l in rows]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, f double, l array<bigint>")
    cols = ["s", "f", "l"]
    got = dict(df.select("i", json_line(*[F.col(c) for c in cols], schema=df.select(*cols).schema)).collect())
    for i, (s, f, l) in enumerate(rows):
        assert got[i] == json.dumps({"s": s, "f": f, "l": l}, ensure_ascii=False), (s, f, l)
