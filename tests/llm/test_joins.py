"""Near duplicates and nearest neighbours against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.llm import neighbours, shingles, similarity
from docferry.llm.common import settle


def shingle(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(words):
    """Edits around the threshold, chains, a shared passage, many copies."""
    rng = random.Random(2)
    rows = []
    for family in range(25):
        text = words(rng.choice([6, 20, 60, 150, 200, 420]), family + 50).split()
        for _ in range(6):
            rows.append(" ".join(text))
            for _ in range(rng.choice([1, 1, 2, 3, max(1, len(text) // 40)])):
                text[rng.randrange(len(text))] = f"w{rng.randrange(1000)}"
    passage = words(70, 999)
    rows += [words(rng.choice([10, 30, 200]), 2000 + i) + " " + passage for i in range(60)]
    rows += [words(90, 4444)] * 80
    for i in range(40):
        t = words(130, 5555).split()
        t[(3 * i) % 130] = f"x{i}"
        rows.append(" ".join(t))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_components_equal_brute_force(spark, words):
    rows = corpus(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((tuple(r) for r in similarity.near_duplicates(docs).collect()), key=repr)
    assert got == brute(rows)
    kept = similarity.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in got})


def test_odd_documents(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(similarity, "BROADCAST_IDS", 0)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted((tuple(r) for r in similarity.near_duplicates(odd_docs).collect()), key=repr)
    assert got == brute(rows)
    kept = similarity.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        [1, 5, 6, 7, 8, 9, 11, 12, 13, 14, None], key=repr)
    assert similarity.near_duplicates(no_docs).count() == 0 and similarity.one_of_each(no_docs).count() == 0


def test_rows_of_one_id_with_different_texts(spark, words):
    a, b, c = words(60, 1), words(60, 2), words(60, 3)
    rows = [(3, a, "x"), (5, a + " more", "x"), (5, b, "x"), (5, b, "y"), (6, b + " more", "x"), (7, c, "x"),
            (7, c + " more", "x"), (8, None, "x"), (8, "", "x")]
    kept = similarity.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sorted((r.doc_id, (r.text or "").removesuffix(" more")) for r in kept) == [
        (3, a), (5, b), (7, c), (8, ""), (8, "")]


def test_cut_buckets_find_every_link(spark, words, monkeypatch, request):
    """Buckets of more than a few members are compared cut by cut, and groups
    go on from one Arrow batch to the next."""
    monkeypatch.setattr(similarity, "CHUNK", 3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    request.addfinalizer(lambda: spark.conf.set(key, before))
    rows = [r for r in corpus(words) if len(r[1].split()) > 100]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in similarity.near_duplicates(docs).collect()), key=repr) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 700), st.integers(0, 200), st.integers(0, 200), st.integers(0, 10**6))
def test_partners_share_the_promised_keys(common, extra_a, extra_b, seed):
    """The pigeonhole bounds, the Hamming bound and the folded sketch."""
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 1 << 63, common + extra_a + extra_b).astype(np.uint64) * np.uint64(2))
    a = np.sort(pool[rng.permutation(len(pool))])[:0]
    mixed = pool[rng.permutation(len(pool))]
    a, b = np.sort(mixed[:common + extra_a]), np.sort(np.concatenate([mixed[:common], mixed[common + extra_a:]]))
    if not len(a) or not len(b):
        return
    both = len(np.intersect1d(a, b))
    la, lb = dict(shingles.levels(len(a))), dict(shingles.levels(len(b)))
    if 100 * both >= 75 * (len(a) + len(b) - both):
        meet = set(la) & set(lb)
        assert meet
        level = min(meet) if len(meet) > 1 else meet.pop()
        ka, na = shingles.block_keys(a, level, la[level])
        kb, nb = shingles.block_keys(b, level, lb[level])
        assert len(np.intersect1d(ka, kb)) >= max(na, nb)
    level = shingles.levels(len(a))[0][0] + 1
    big = shingles.sketch(a, level).view(np.uint8)
    half = len(big) // 2
    assert (big[:half] ^ big[half:] == shingles.sketch(a, level - 1).view(np.uint8)).all()
    apart = np.unpackbits(big ^ shingles.sketch(b, level).view(np.uint8)).sum()
    assert apart <= len(a) + len(b) - 2 * both


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "A", "bb", "é", "É", "x" * 256, "x" * 257, "X" * 300, " ", "\t", "\n", "\x0b", "\x85", "\u3000"]),
                         max_size=30).map("".join), max_size=6))
def test_sets_of_many_texts_are_those_of_each(texts):
    """Texts hashed together: no shingle reaches into the next text."""
    wanted = [shingle_of_bytes(t) for t in texts]
    sets = shingles.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(w) for w in wanted]
    for s, w, t in zip(sets, wanted, texts, strict=True):
        assert (s == shingles.shingle_set(t.encode())).all() and len(s) == len(np.unique(s)) and (np.sort(s) == s).all()
        for other, v in zip(sets, wanted, strict=True):
            assert len(np.intersect1d(s, other)) == len(w & v)
    digests = shingles.set_digests(sets)
    assert [d is None for d in digests] == [not w for w in wanted]
    assert len(set(digests) - {None}) == len({frozenset(w) for w in wanted if w})


def shingle_of_bytes(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_words_are_hashed_without_a_cache(monkeypatch):
    def never(*_):
        raise AssertionError("a word went through the cache")

    monkeypatch.setattr("docferry.llm.words.WordHashes.of", never)
    assert len(shingles.shingle_set(b"one two three four five six")) == 2


def test_kept_rows_are_read_without_a_shuffle_of_texts(spark):
    docs = spark.createDataFrame([(i, f"some text of number {i} and more words", "x") for i in range(30)], "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = similarity.one_of_each(docs)
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_settled_tables_leave_no_shuffle_files(spark):
    def held():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
        return blocks.size()

    before = held()
    out = settle(spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).count(), "few")
    assert held() <= before and out.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "x long, y long")
    got = {r.node: r.root for r in similarity.components(edges).collect()}
    assert {got[i] for i in range(61)} == {0} and got[101] == 100


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def best(rows, queries, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, x in ok:
        if q in queries:
            found = sorted(((-float(np.dot(y, x)), i) for i, y in ok if i != q))[:k]
            out[q] = [i for _, i in found]
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 24))
    x = (centre[rng.integers(0, 12, 1500)] + 0.7 * rng.normal(size=(1500, 24))).astype(np.float32)
    x *= rng.uniform(0.5, 2.0, (1500, 1)).astype(np.float32)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    df = vectors(spark, [(i, v, 0) for i, v in rows])
    got: dict = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = best(rows, set(range(0, 1500, 20)), 10)
    hits = [len({v for _, v, _ in got[q]} & set(want[q])) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert found == sorted(found, key=lambda f: (-f[2], f[1])) or [f[1] for f in sorted(found, key=lambda f: (-f[2], f[1]))] == [f[1] for f in found]
        for _, v, s in found:
            assert s == pytest.approx(float(np.dot(x[q].astype(float), x[v].astype(float))), abs=1e-12)


def test_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 30)]
    odd = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [float("nan"), 1.0, 1.0]),
           (200, [float("inf"), 1.0, 1.0]), (220, [1.0, 2.0]), (None, same), (20, same)]
    df = vectors(spark, [(i, v, 0) for i, v in rows + odd]).withColumn("vec", F.lit(1)).withColumn("score", F.lit(2))
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {0: list(range(1, 21)), 20: list(range(0, 20))}


def test_few_and_no_vectors(spark):
    far = vectors(spark, [(0, [1.0, 0.0], 0), (1, [-9.0, 0.0], 0), (2, [0.0, 50.0], 0)])
    got = neighbours.search(far, F.col("vec_id") % 20 == 0, k=20).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 0.0), (0, 2, 1, -9.0)]
    assert neighbours.search(far.limit(0), F.col("vec_id") % 20 == 0, k=20).count() == 0


@pytest.mark.parametrize("ids", [300_000, 0])
def test_near_copies_without_ids(spark, words, monkeypatch, ids):
    monkeypatch.setattr(similarity, "BROADCAST_IDS", ids)

    def changed(text, *places):
        t = text.split()
        for at in places:
            t[at] = f"x{at}"
        return " ".join(t)

    a, b, c = words(100, 1), words(100, 2), words(100, 3)
    rows = [(None, a), (None, changed(a, 50)), (None, changed(a, 50)),
            # The row without an id is the only bridge.
            (1, b), (None, changed(b, 20, 30)), (2, changed(b, 20, 30, 50, 60)), (3, changed(b, 20, 30, 50, 60, 80)),
            (4, c), (None, changed(c, 70)), (5, words(100, 4)), (None, words(100, 5)), (None, None), (None, "")]
    bridge = [shingle(t) for _, t in rows[3:6]]
    assert len(bridge[0] & bridge[2]) * 100 < 75 * len(bridge[0] | bridge[2])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in similarity.near_duplicates(docs).collect()), key=repr)
    assert got == brute(rows)
    kept = [(r.doc_id, r.text) for r in similarity.one_of_each(docs).collect()]
    assert sorted(d for d, _ in kept if d is not None) == [1, 4, 5]
    # One near copy of ``a``, the text alone and the two without words.
    assert sum(d is None for d, _ in kept) == 4 and sum(t in (a, changed(a, 50)) for _, t in kept) == 1
    alone = docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert similarity.one_of_each(alone).filter("text != ''").count() == 5
