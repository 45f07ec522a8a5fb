"""Exact encoding, token files and packing against the tokenizer itself."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docferry.llm import packing, pfor
from docferry.llm.tokens import SPACED_RUNS, WORD_RUNS, encoder

KINDS = [("word_bpe_49k.json", WORD_RUNS), ("byte_bpe_50k.json", SPACED_RUNS)]
PIECES = st.sampled_from(list("ab'sSZ1 9\t\n\r .,!é 　\x0b\x1c\x85ßİﬁ가́Éµ") + ["<|endoftext|>", "'ll", " the", "ÜÉx."])


def plain(name: str, text: str) -> bytes:
    ids = Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("name,cuts", KINDS)
def test_chunks_give_the_ids_of_the_whole_text(name, cuts):
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    enc = encoder(name, cuts)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(PIECES, max_size=14).map("".join))
    def check(text):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert enc.encode(text.encode()) == np.array(ids, "<u4").tobytes()

    check()


def test_a_full_cache_keeps_working():
    from docferry.llm.tokens import ChunkEncoder, vocabulary

    enc = ChunkEncoder(vocabulary(KINDS[1][0]), SPACED_RUNS, cache_chunks=4)
    for text in ("one two three four five six", "seven eight nine ten", "one two three"):
        assert enc.encode(text.encode()) == plain(KINDS[1][0], text)
    assert len(enc) < 16


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=3000))
def test_blocks_round_trip(values):
    ids = np.array(values, "<u4")
    data = pfor.segment(3, 5, [7, None], [len(ids), 0], ids.tobytes()) + b"\n"
    (part, first, docs, lengths, back), = pfor.segments(data)
    assert (part, first, docs, lengths.tolist()) == (3, 5, [7, None], [len(ids), 0])
    assert back.tolist() == values


def test_outliers_become_exceptions():
    ids = np.array([100 + i % 16 for i in range(2048)], np.uint32)
    ids[[5, 900, 2000]] = 4_000_000_000
    index, more, packed, blocks, exceptions = pfor.pack_ids(ids)
    assert (blocks, exceptions) == (2, 3) and len(packed) == 2 * 1024 * 4 // 8


def test_a_cut_file_is_an_error():
    data = pfor.segment(0, 0, [1], [3], np.array([1, 2, 3], "<u4").tobytes())
    with pytest.raises(ValueError):
        list(pfor.segments(data[:-2] + b"\n"))


def test_token_files(spark, odd_docs, tmp_path):
    path = str(tmp_path / "ids")
    pfor.write(odd_docs, path, tokenizer=KINDS[0][0], files=4)
    got = pfor.with_starts(pfor.read(spark, path)).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    at = 0
    for r, (_, text) in zip(got, rows, strict=True):
        ids = plain(KINDS[0][0], text or "") + np.array([2], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4


def test_no_documents(spark, no_docs, tmp_path):
    path = str(tmp_path / "none")
    pfor.write(no_docs, path, tokenizer=KINDS[0][0])
    assert pfor.with_starts(pfor.read(spark, path)).count() == 0
    assert packing.pack(packing.pieces(no_docs, tokenizer=KINDS[1][0])).count() == 0


def test_packing(odd_docs):
    got = packing.pack(packing.pieces(odd_docs, tokenizer=KINDS[1][0]), group_pieces=20).collect()
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in odd_docs.collect():
        ids = plain(KINDS[1][0], r.text or "") + np.array([2], "<u4").tobytes()
        own = [p for p in by_doc[r.doc_id]]
        if r.doc_id is None or r.doc_id == 12:
            continue  # several rows with this id
        own.sort(key=lambda p: p.piece)
        assert [p.piece for p in own] == list(range(len(own)))
        assert all(p.length == 1024 for p in own[1:]) and sum(p.length for p in own) == len(ids) // 4
        for p in own:
            assert zlib.crc32(ids[4 * p.start:4 * (p.start + p.length)]) == p.ids_crc32
    places: dict = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_local_search_keeps_all_pieces_and_never_adds_bins(lengths):
    bins = packing.best_fit(lengths, 64)
    better = packing.local_search([list(b) for b in bins], lengths, 64)
    assert sorted(i for b in better for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 64 for b in better)
    assert len(better) <= len(bins)


@pytest.mark.parametrize("seed", range(30))
def test_local_search_leaves_no_step(seed):
    """Every move and every exchange of one or two pieces, tried one by one."""
    rng = random.Random(seed)
    cap = 60
    lengths = [rng.choice([rng.randint(1, 6), rng.randint(14, 24), rng.randint(25, 40)]) for _ in range(50)]
    bins = packing.local_search(packing.best_fit(lengths, cap), lengths, cap)
    fill = [sum(lengths[i] for i in b) for b in bins]
    assert max(fill) <= cap and sorted(i for b in bins for i in b) == list(range(50))
    if len(bins) == -(-sum(lengths) // cap):
        return
    for b, mine in enumerate(bins):
        given = [lengths[i] for i in mine] + [lengths[i] + lengths[k] for x, i in enumerate(mine) for k in mine[x + 1:]]
        for j, theirs in enumerate(bins):
            if j == b or cap in (fill[b], fill[j]):
                continue
            assert not any(fill[j] + lengths[i] <= cap and fill[j] + lengths[i] > fill[b] for i in mine)
            assert not any(0 < t - lengths[i] <= cap - fill[j] and fill[j] + t - lengths[i] > fill[b]
                           for t in given for i in theirs)


def test_local_search_empties_a_bin():
    # 6+3 / 5+4 / 1 in bins of 10: swapping fills one bin and empties another
    lengths = [6, 3, 5, 4, 1, 1]
    better = packing.local_search([[0, 1], [2, 3], [4], [5]], lengths, 10)
    assert len(better) == 2
