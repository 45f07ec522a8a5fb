"""Shortest-pack-first against placing one piece at a time, and whole layouts."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docferry.llm import histogram_packing as hp
from docferry.llm.tokens import WORD_RUNS


def one_by_one(lengths: list[int], capacity: int) -> list[int]:
    """Fills when each piece, longest first, goes to the shortest pack if it has room."""
    fills: list[int] = []
    for n in sorted(lengths, reverse=True):
        if fills and min(fills) + n <= capacity:
            fills[fills.index(min(fills))] += n
        else:
            fills.append(n)
    return sorted(fills)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=80) | st.lists(st.sampled_from([1, 2, 3, 40]), max_size=200))
def test_patterns_equal_placing_one_piece_at_a_time(lengths):
    patterns = hp.shortest_pack_first(Counter(lengths), 64)
    fills = [p.fill for p in patterns for _ in range(p.count)]
    assert len(fills) == len(one_by_one(lengths, 64))
    held: Counter = Counter()
    for p in patterns:
        assert p.fill == sum(n * c for n, c in p.runs) <= 64
        for n, c in p.runs:
            held[n] += c * p.count
    assert held == Counter(lengths)


def test_a_histogram_of_billions_stays_small():
    patterns = hp.shortest_pack_first({n: 10**9 // n for n in range(1, 4096)}, 4096)
    assert len(patterns) < 40_000
    assert sum(p.count * p.fill for p in patterns) == sum(n * (10**9 // n) for n in range(1, 4096))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=60), st.sampled_from([1, 4, 16]))
def test_every_place_is_taken_once(lengths, least_gap):
    layout = hp.lay_out(Counter(lengths), 64, least_gap)
    seen: Counter = Counter()
    ranks = []
    for n in lengths:
        ranks.append(seen[n])
        seen[n] += 1
    sequence, offset, loose = hp.place(layout, np.array(lengths), np.array(ranks))
    held: dict[int, list[tuple[int, int]]] = {}
    for n, s, o, is_loose in zip(lengths, sequence.tolist(), offset.tolist(), loose.tolist(), strict=True):
        pieces = hp.cut_loose(layout, s, n) if is_loose else [(n, s, o)]
        assert sum(p[0] for p in pieces) == n
        for length, seq, off in pieces:
            held.setdefault(seq, []).append((off, length))
    padding = 0
    for pieces in held.values():
        at = 0
        for off, length in sorted(pieces):
            assert off == at
            at += length
        assert at <= 64
        padding += 0 if at & (at - 1) == 0 else 64 - at
    assert padding <= (least_gap - 1) * len(held)


def rows_of(docs, capacity, least_gap=4):
    rows = hp.encode(docs, tokenizer="word_bpe_49k.json", cuts=WORD_RUNS, end_id=2, capacity=capacity)
    return hp.pack(rows, capacity=capacity, least_gap=least_gap).collect()


@pytest.mark.parametrize("capacity", [64, 4096])
def test_odd_documents(odd_docs, capacity):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = rows_of(odd_docs.repartition(3), capacity)
    source = odd_docs.collect()
    ids = [library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in source]
    # Pieces of equal documents can't be told apart: compare them as multisets.
    assert sum(r.length for r in found) == sum(map(len, ids))
    assert Counter((r.doc_id, r.doc_tokens) for r in found if r.start == 0) == Counter(
        (r.doc_id, len(i)) for r, i in zip(source, ids, strict=True))
    by_key = {(r.doc_id, len(i)): np.array(i, "<u4") for r, i in zip(source, ids, strict=True)}
    places: dict[int, list[tuple[int, int]]] = {}
    for r in found:
        part = by_key[r.doc_id, r.doc_tokens][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for off, length in sorted(pieces):
            assert off == at
            at += length
        assert at <= capacity


def test_equal_lengths_of_many_partitions(spark, words):
    docs = spark.range(900).selectExpr("id doc_id", "'one two three' text").repartition(7)
    found = rows_of(docs, 64)
    fills = Counter()
    for r in found:
        fills[r.sequence_id] += r.length
    assert sorted(r.doc_id for r in found if r.start == 0) == list(range(900))
    assert sum(fills.values()) == 900 * 4 and max(fills.values()) <= 64
    assert len(fills) == -(-900 * 4 // 64) or sum(64 - n for n in fills.values() if n & (n - 1)) == 0


def test_no_documents(no_docs):
    assert rows_of(no_docs, 4096) == []
