"""Ordered exports, byte ranges and hash trees against plain Python."""

from __future__ import annotations

import hashlib
import random
from datetime import date, datetime

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.operators import byte_ranges, tree_digest
from docferry.operators.ordered_export import (
    buckets_of, numbered_lines, records, write_ordered)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_root(lines: list[str]) -> str:
    level = [sha("0" + x) for x in lines]
    if not level:
        return sha("")
    while len(level) > 1:
        level = [sha("1" + level[i] + level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def lines_frame(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "idx long, line string").repartition(5)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1023, 1024, 1025, 2049, 5000])
def test_roots(spark, out_dir, n):
    lines = [f"line {i} é" for i in range(n)]
    nodes = tree_digest.build(lines_frame(spark, lines), f"{out_dir}/tree")
    assert tree_digest.root(nodes) == plain_root(lines)


def test_three_levels_of_chunks(spark, out_dir, monkeypatch):
    monkeypatch.setattr(tree_digest, "STEP", 2)
    monkeypatch.setattr(tree_digest, "CHUNK", 4)
    lines = [f"line {i}" for i in range(150)]
    frame = lines_frame(spark, lines)
    nodes = tree_digest.build(frame, f"{out_dir}/tree")
    digest = tree_digest.root(nodes)
    assert digest == plain_root(lines)
    wanted = frame.filter("idx in (0, 3, 77, 148, 149)")
    proof = tree_digest.proofs(nodes, frame, wanted.select("idx"))
    assert {(r.idx, r.proven) for r in tree_digest.proven(wanted, proof, digest).collect()} == {
        (i, True) for i in (0, 3, 77, 148, 149)}
    forged = wanted.withColumn("line", F.concat("line", F.lit(" ")))
    assert not any(r.proven for r in tree_digest.proven(forged, proof, digest).collect())
    for change in ({5: "x"}, {149: "x", 0: "y"}, {}):
        other = lines_frame(spark, [change.get(i, x) for i, x in enumerate(lines)])
        theirs = tree_digest.build(other, f"{out_dir}/other")
        chunks = tree_digest.changed_chunks(nodes, theirs)
        assert {r.idx for r in chunks.collect()} == {i // 4 for i in change}
        assert {r.idx for r in tree_digest.changed_lines(frame, other, chunks).collect()} == set(change)


@pytest.mark.parametrize("n", [149, 151, 30, 700])
def test_trees_of_different_lengths(spark, out_dir, monkeypatch, n):
    monkeypatch.setattr(tree_digest, "STEP", 2)
    monkeypatch.setattr(tree_digest, "CHUNK", 4)
    a, b = [f"line {i}" for i in range(150)], [f"line {i}" for i in range(n)]
    ours, theirs = (tree_digest.build(lines_frame(spark, x), f"{out_dir}/{k}") for k, x in enumerate((a, b)))
    chunks = tree_digest.changed_chunks(ours, theirs)
    found = tree_digest.changed_lines(lines_frame(spark, a), lines_frame(spark, b), chunks)
    assert {r.idx for r in found.collect()} == set(range(min(150, n), max(150, n)))


KEY = st.tuples(st.none() | st.text(max_size=3), st.none() | st.integers(-(1 << 63), (1 << 63) - 1),
                st.none() | st.sampled_from([date(1960, 1, 1), date(2024, 2, 29)]),
                st.none() | st.sampled_from([datetime(1950, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1)]))


@settings(max_examples=15, deadline=None)
@given(st.lists(KEY, min_size=2, max_size=30))
def test_keys_sort_as_their_columns(spark, rows):
    rows = [r for r in rows if r[0] is None or "\ud800" > max(r[0] + "a")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, n long, d date, t timestamp")
    keyed = df.select("*", byte_ranges.order_key(df, ["s", "n", "d", "t"]).alias("key"))
    by_columns = [r.key for r in keyed.orderBy("s", "n", "d", "t").collect()]
    assert by_columns == sorted(by_columns)
    assert len(set(by_columns)) == len(set(rows))


def test_summaries_keep_the_weight():
    keys = pa.array([f"{i:06d}" for i in range(5000)])
    import numpy as np

    kept, sizes = byte_ranges.compress(keys, np.ones(5000), 100, 0.5)
    assert len(kept) == 100 and abs(sizes.sum() - 5000) < 1e-6
    assert max(abs(int(k) - (50 * i + 25)) for i, k in enumerate(kept.to_pylist())) <= 1


def test_a_hot_line_is_split_and_parts_are_one_order(spark, out_dir):
    rng = random.Random(3)
    rows = [(rng.choice([None, "b", "a"]), "hot, line") for _ in range(3000)]
    rows += [(rng.choice(["a", "b", "c"]), f"line {rng.random()}" + " " * rng.randrange(60)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "k string, line string").repartition(6)
    target = 8000
    done = write_ordered(df, ["k"], ["line"], out_dir=out_dir, target_bytes=target, entries=512)
    parts = spark.read.parquet(done.manifest_path).orderBy("bucket").collect()
    assert len(parts) == done.n_parts > 20 and max(p.bytes for p in parts) <= 1.5 * target
    lines = [r.line for r in numbered_lines(spark, done).orderBy("idx").collect()]
    assert [tuple(r) for r in sorted(
        ((k is not None, k or "", hashlib.md5(x.encode()).hexdigest(), x) for k, x in rows))] == sorted(
        ((k is not None, k or "", hashlib.md5(x.encode()).hexdigest(), x) for k, x in rows))
    want = [x for _, _, _, x in sorted((k is not None, k or "", hashlib.md5(x.encode()).hexdigest(), x) for k, x in rows)]
    assert lines == want
    assert done.root == plain_root(want)
    # However it is cut, the digest is the same.
    again = write_ordered(df.repartition(2), ["k"], ["line"], out_dir=f"{out_dir}/again", target_bytes=10**9)
    assert again.n_parts == 1 and again.root == done.root


def test_changed_part_is_found(spark, out_dir):
    df = spark.range(5000).selectExpr("id", "concat('row ', id) line")
    done = write_ordered(df, ["id"], ["line"], out_dir=out_dir, target_bytes=6000, entries=512)
    lines = numbered_lines(spark, done)
    copy = lines.withColumn("line", F.when(F.col("idx") == 2600, "changed").otherwise(F.col("line")))
    theirs = tree_digest.build(copy, f"{out_dir}/copy")
    chunks = tree_digest.changed_chunks(tree_digest.read(spark, done.tree_path), theirs)
    parts = buckets_of(spark, done, chunks)
    assert 0 < len(parts) < done.n_parts
    found = tree_digest.changed_lines(numbered_lines(spark, done, parts), copy, chunks)
    assert [r.idx for r in found.collect()] == [2600]


def test_no_rows(spark, out_dir):
    df = spark.createDataFrame([], "id long, line string")
    done = write_ordered(df, ["id"], ["line"], out_dir=out_dir)
    assert (done.row_count, done.n_parts, done.root) == (0, 1, sha(""))


def test_records_with_line_breaks():
    assert records(b'a,b\n"x\ny","1"\n"""\n""",2\n') == [b"a,b", b'"x\ny","1"', b'"""\n""",2']
    with pytest.raises(ValueError):
        records(b'"open\n')


def test_orders_of_doubles_are_refused(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        byte_ranges.order_key(df, ["x"])
