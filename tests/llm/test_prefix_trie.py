"""The trie against a brute-force one, and subtree sums of random forests."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from docferry.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows) -> set:
    turns: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c in turns:
        turns[c] = [(r, t) for _, _, r, t in sorted(turns[c])]
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members: dict[tuple, list[int]] = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids: dict[tuple, list] = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, set()
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        saved[node] = own + sum(saved[k] for k in below)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out.add((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                 len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_rows(spark, rows) -> list[tuple]:
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x1", F.lit("clash")).withColumn("depth", F.lit("clash"))
    return [tuple(r) for r in prefix_trie.trie(df.repartition(3)).collect()]


def test_odd_conversations(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(-25, 45), 400, 2**40, 2**40 + 1]:
        if c == 20:
            continue  # a base that isn't there
        for turn in range(rng.randrange(1, 7) if c % 20 else rng.randrange(1, 3)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b\tc", "", None, "x"])))
    # Nulls in every column, ties, repeated rows, rows without a conversation.
    rows += [(7, None, None, None), (7, None, None, None), (7, 0, "user", "later"), (7, 0, "user", "earlier"),
             (None, 0, "user", "no conversation"), (None, None, None, None)]
    # A chain far longer than a partition, and many equal conversations.
    rows += [(9000, t, "user", f"turn {t} é") for t in range(700)]
    rows += [(c, t, "user", "common") for c in range(10_000, 10_400) for t in range(5)]
    rng.shuffle(rows)
    found = trie_rows(spark, rows)
    want = brute(rows)
    assert len(found) == len(want)
    assert set(found) == want


def test_no_conversations(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("shape", ["random", "chain", "star", "comb", "single"])
def test_subtree_sums_of_forests(spark, shape):
    rng = random.Random(shape)
    n = 1 if shape == "single" else 300
    parent = {0: None}
    for v in range(1, n):
        parent[v] = {"random": rng.randrange(v) if v % 50 else None, "chain": v - 1, "star": 0,
                     "comb": v - 1 if v % 2 == 0 else max(0, v - 2)}[shape]
    weight = {v: rng.randrange(100) for v in parent}
    total = dict(weight)
    for v in sorted(parent, reverse=True):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    tree = spark.createDataFrame([(v, parent[v], weight[v]) for v in parent], "v long, p long, w long")
    assert dict(map(tuple, prefix_trie.subtree_totals(tree, ["w"]).collect())) == total


def test_long_lists_of_ids_pass_through_chunks(spark):
    ends = spark.range(50_000).selectExpr("cast(id % 3 = 0 as long) depth", "7L x1", "9L x2", "id * 3 - 1000 conv")
    got = {r.depth: r.ends_sha256 for r in prefix_trie._ends_digests(ends).collect()}
    for depth in (0, 1):
        ids = sorted(i * 3 - 1000 for i in range(50_000) if (i % 3 == 0) == bool(depth))
        assert got[depth] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
