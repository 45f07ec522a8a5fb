"""Collocations against brute-force counts."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.llm import collocations as col


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(rows, least=10, top=2000) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        counter = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                counter.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer: Counter = Counter()
        for p, a in frequent.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for p, a in frequent.items():
            if len(p) == 2 and longer[p] and 100 * longer[p] >= 50 * a:
                continue
            score, _, left, right = min((floor(Fraction(10**6 * a * a, f[p[:k]] * f[p[k:]])), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def text_of(rng, words, n) -> str:
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = ["the"] * 30 + ["The", "of", "of", "New", "york", "city", "É", "é", "x\x1cy", "n\x00", "a\x85b"] + [
        f"w{i}" for i in range(25)]
    rows = [(rng.choice(["en", "de", None, "und", ""]), text_of(rng, words, rng.randrange(0, 120))) for _ in range(150)]
    rows += [("en", "the " * 4000), ("fr", None), (None, None), ("fr", ""), ("en", "?!.,;:\n\x0b\x0c\r")]
    rows += [("de", "ein  fester SATZ steht hier")] * 40 + [("de", "ein fester zaun")] * 9
    return rows


@pytest.mark.parametrize("range_words", [1_500_000, 40])
def test_brute_force(spark, corpus, monkeypatch, range_words):
    monkeypatch.setattr(col, "SAMPLE_EVERY", 8)
    df = spark.createDataFrame(corpus, "lang string, text string").repartition(4)
    for name in ("word", "n", "part", "rank", "w1"):
        df = df.withColumn(name, F.lit("clash"))
    found = col.collocations(df, range_words=range_words)
    assert sorted(map(tuple, found.collect())) == brute(corpus)


def test_few_are_reported(spark, corpus):
    df = spark.createDataFrame(corpus, "lang string, text string")
    found = col.collocations(df, least=3, top=5)
    assert sorted(map(tuple, found.collect())) == brute(corpus, 3, 5)


def test_no_documents(spark):
    assert col.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert col.collocations(spark.createDataFrame([("en", "a b")], "lang string, text string")).collect() == []


def test_words_with_one_hash_are_told_apart(spark, monkeypatch):
    plain = col.xxhash.xxh3_64_intdigest

    class Colliding:
        @staticmethod
        def xxh3_64_intdigest(data, seed=0):
            if data in (b"left", b"right") and seed == plain(b"en", 0):
                return 12345
            return plain(data, seed)

    monkeypatch.setattr(col, "xxhash", Colliding)
    codes = col.Codes(b"en", 0)
    assert codes.of([b"left"]) == codes.of([b"right"])
    assert col.Codes(b"en", 1).of([b"left"]) != col.Codes(b"en", 1).of([b"right"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.integers(1, 5))
def test_three_way_counts(codes, least):
    whole = np.array([*codes, 0, 0], np.uint64) * np.uint64(1 << 61)
    keys, counts = col.merge_chunk(whole)
    suffix = Counter()
    want: Counter = Counter()
    for i, c in enumerate(codes):
        tail = [*codes, 0, 0][i:i + 3]
        tail = tail[:tail.index(0)] if 0 in tail else tail
        if c:
            suffix[tuple(tail)] += 1
            want.update(tuple(tail[:n]) for n in range(1, len(tail) + 1))
    assert int(counts.sum()) == sum(suffix.values()) and keys.shape[1] == len(suffix)
    common = np.array([0, 3 << 61], np.uint64)
    if keys.shape[1]:
        back, n = col.read_block(col.write_block(keys, counts, common), common)
        assert (back == keys).all() and (n == counts).all()
    rows = zip(*[c.tolist() for c in col.three_way(keys, counts, least)], strict=True)
    got = {tuple(int(w) >> 61 for w in r[:3] if w): tuple(r[3:]) for r in rows}
    assert got == {p: (a, want[p[:1]], want[p[:2]]) for p, a in want.items() if len(p) > 1 and a >= least}
