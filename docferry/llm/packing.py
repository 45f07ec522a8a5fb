"""Best-fit packing with a swap-based local search.

``pieces`` cuts documents' ids into pieces of at most ``capacity`` ids (only
longer documents are cut; the first piece is the shorter one). ``pack`` places
pieces in sequences: pieces are dealt to groups of about ``GROUP_PIECES`` by
row number, so each group has the table's mix of lengths however skewed it is.
Within a group, best fit in descending length makes the first bins; then, from
the emptiest bin up, documents are exchanged one for one or two for one, or
moved, between underfull bins, each step raising the sum of squared fills,
until bins are empty or no step does. No step and no pair of pieces is left out:
the sum of squared fills bounds the steps.

A group has one bin more than its ids need at worst where the search ends with
a rest, so the loss is about one sequence in ``GROUP_PIECES`` pieces.

Defined cases: a null text is empty; a document holds its end id at least, so
each has a piece; repeated rows are packed as often as they occur; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import settle, utf8
from docferry.llm.tokens import CACHE_CHUNKS, SPACED_RUNS, encoder

CAPACITY = 1024
GROUP_PIECES = 40_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, *, tokenizer: str, cuts: str = SPACED_RUNS, end_id: int = 2,
           capacity: int = CAPACITY, cache_chunks: int = CACHE_CHUNKS) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32."""
    end = struct.pack("<I", end_id)

    def cut(batches):
        enc = encoder(tokenizer, cuts, cache_chunks)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                raw = enc.encode(text) + end
                n = len(raw) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    out.append((doc_id, piece, at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
                    at += size
                    piece += 1
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit in descending length: bins of places in ``lengths``."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    some = 0  # bit r: a bin with room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = some >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some &= ~(1 << r)
            bins[b].append(i)
            r -= n
        else:
            b = len(bins)
            bins.append([i])
            r = capacity - n
        if r:
            room[r].append(b)
            some |= 1 << r
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Exchange and move pieces between underfull bins, each step raising the
    sum of squared fills, starting at the emptiest bin, until no step does
    or there are as few bins as the sum of lengths needs."""
    least = -(-sum(lengths) // capacity)
    fills = [sum(lengths[i] for i in b) for b in bins]
    if len(bins) <= least:
        return bins
    under = np.array(sorted((b for b in range(len(bins)) if fills[b] < capacity), key=lambda b: fills[b]), np.int64)
    items = [i for b in under.tolist() for i in bins[b]]
    size = np.array([lengths[i] for i in items], np.int64)
    home = np.array([b for b in under.tolist() for _ in bins[b]], np.int64)
    fill = np.full(len(bins), capacity, np.int64)
    fill[under] = [fills[b] for b in under.tolist()]
    alive = len(bins)

    def place(k: int, b: int) -> None:
        fill[home[k]] -= size[k]
        fill[b] += size[k]
        home[k] = b

    def move(b: int, mine: list[int]) -> bool:
        """The largest piece that fits elsewhere into the fullest bin with room."""
        others = under[(under != b) & (fill[under] > 0) & (fill[under] < capacity)]
        free = capacity - fill[others]
        for k in mine:
            fits = np.flatnonzero((free >= size[k]) & (fill[others] + size[k] > fill[b]))
            if len(fits):
                place(k, int(others[fits[np.argmin(free[fits])]]))
                return True
        return False

    def exchange(b: int, mine: list[int]) -> bool:
        """One or two pieces for one of another bin: the exchange that raises
        the sum of squares most. The more the other bin gains the better, so
        for each of its pieces only the largest total that fits counts."""
        by_size: dict[int, list[int]] = {}
        for k in mine:
            by_size.setdefault(int(size[k]), []).append(k)
        given = {n: ks[:1] for n, ks in by_size.items()}
        # Different sizes of one bin: fewer than sqrt(2 * capacity).
        for n, ks in by_size.items():
            for m, others in by_size.items():
                pair = [ks[0], others[0]] if n > m else ks[:2] if n == m else []
                if len(pair) == 2:
                    given.setdefault(n + m, pair)
        largest = np.zeros(2 * capacity + 1, np.int64)
        largest[list(given)] = list(given)
        largest = np.maximum.accumulate(largest)
        theirs = np.flatnonzero((home != b) & (fill[home] < capacity))
        full = fill[home[theirs]]
        total = largest[size[theirs] + capacity - full]
        gain = total - size[theirs]
        # Half the change of the sum of squares.
        change = np.where(gain > 0, gain * (full + gain - fill[b]), 0)
        x = int(np.argmax(change)) if len(change) else 0
        if not len(change) or change[x] <= 0:
            return False
        to = int(home[theirs[x]])
        for k in given[int(total[x])]:
            place(k, to)
        place(int(theirs[x]), b)
        return True

    again = True
    while again and alive > least:
        again = False
        for b in under[np.argsort(fill[under], kind="stable")].tolist():
            if alive <= least:
                break
            there = fill[b] > 0
            while 0 < fill[b] < capacity:
                mine = np.flatnonzero(home == b)
                mine = mine[np.argsort(-size[mine], kind="stable")].tolist()
                if not (move(b, mine) or exchange(b, mine)):
                    break
                again = True
            alive -= bool(there and fill[b] == 0)
    out = [b for x, b in enumerate(bins) if fills[x] >= capacity]
    packed: dict[int, list[int]] = {}
    for i, b in zip(items, home.tolist(), strict=True):
        packed.setdefault(b, []).append(i)
    return out + list(packed.values())


def pack(rows: DataFrame, *, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces."""
    rows = settle(rows, "pieces")
    n = rows.count()
    groups = max(1, -(-n // group_pieces))
    # Rows of a written table have fixed numbers; their hash deals them evenly.
    dealt = rows.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def fill(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reset_index(drop=True)
        lengths = pdf["length"].tolist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence = np.zeros(len(pdf), np.int64)
        offset = np.zeros(len(pdf), np.int64)
        for s, members in enumerate(bins):
            at = 0
            for i in members:
                sequence[i] = (int(key[0]) << 32) + s
                offset[i] = at
                at += lengths[i]
        return pdf.drop(columns="g").assign(sequence_id=sequence, offset=offset)

    return dealt.groupBy("g").applyInPandas(fill, PIECES + ", sequence_id long, offset long")
