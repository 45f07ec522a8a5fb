"""Cell text and CSV bytes against Python's csv module."""

from __future__ import annotations

import csv
import io
import random
import struct

from pyspark.sql import functions as F

from docferry.functions.render import (
    basename, csv_line, formula_guard, header_line, py_float_text, sidecar_name)

HOSTILE = ["", "a", " x ", "a,b", 'a"b', "a\nb", "a\rb", "\t", "#x", "\\", '\\"x',
           "é😀", "=1+1", '""', "a\r\nb"]


def _py_line(values):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerow(values)
    return buf.getvalue()[:-1]


def test_csv_two_columns_match_python(spark):
    data = [(a, b) for a in HOSTILE for b in HOSTILE]
    df = spark.createDataFrame(data, "a string, b string")
    got = [r[0] for r in df.select(csv_line([F.col("a"), F.col("b")])).collect()]
    assert got == [_py_line(list(r)) for r in data]


def test_csv_single_column_match_python(spark):
    df = spark.createDataFrame([(v,) for v in HOSTILE], "a string")
    got = [r[0] for r in df.select(csv_line([F.col("a")])).collect()]
    assert got == [_py_line([v]) for v in HOSTILE]


def test_header_quoting():
    assert header_line(["a", "b,c", 'd"']) == 'a,"b,c","d"""'


def test_float_text_matches_python_repr(spark):
    vals = [0.0, -0.0, 1.0, 123.45, 1e16, 1.5e16, 9999999999999998.0, 1e7, 12345678.9,
            0.0001, 0.00012, 1e-05, 1.7976931348623157e308, -2.5e-7, 3.14, 100.0, 0.1,
            1e22, 123456789012345.6, 0.001, 0.00099, float("nan"), float("inf"), -float("inf")]
    rnd = random.Random(7)
    for _ in range(500):
        vals.append(struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0])
        vals.append(round(rnd.uniform(-1e6, 1e6), rnd.randint(0, 6)))
    vals = [v for v in vals if v == v or repr(v) == "nan"]
    vals = [v for v in vals if not (v != 0 and abs(v) < 2.3e-308)]  # skip subnormals
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.t for r in df.select("i", py_float_text(F.col("v")).alias("t")).collect()}
    bad = [(vals[i], t) for i, t in got.items() if t != repr(vals[i])]
    assert bad == []


def test_formula_guard(spark):
    df = spark.createDataFrame([("=1+1",), ("+a",), ("-b",), ("@c",), ("ok",), ("",)], "s string")
    got = [r[0] for r in df.select(formula_guard(F.col("s"))).collect()]
    assert got == ["'=1+1", "'+a", "'-b", "'@c", "ok", ""]


def test_basename_and_sidecar(spark):
    df = spark.createDataFrame([("upload/x.csv",), ("x.csv",), ("a/b/",)], "r string")
    got = [tuple(r) for r in df.select(basename(F.col("r")), sidecar_name(F.col("r"))).collect()]
    assert got == [("x.csv", "upload/x.csv.sha256"), ("x.csv", "x.csv.sha256"), ("b", "a/b/.sha256")]
