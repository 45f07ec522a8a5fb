"""Shortest-pack-first packing over the histogram of lengths.

Whole pieces of ``capacity`` ids are sequences of their own; what is left of
each document (all of it, where it is shorter) counts in a histogram of lengths,
which has fewer than ``capacity`` entries however large the table is.
``shortest_pack_first`` places the histogram's lengths, longest first, each into
the shortest packs that have room, and keeps packs of equal contents as one
pattern with a count. Documents find their places by rank: the r-th piece of a
length takes the r-th place that the patterns have for that length.

A rank is an offset of the piece's input partition (sums of counts for each
partition and length) plus its place among that partition's pieces of the
length, so equal lengths are neither sorted nor gathered.

As documents may be cut, packs that stay underfull are mended: the emptiest
packs are taken apart, and their ids, as one stream, fill the gaps of the
others (``mend``). Gaps below ``least_gap`` ids are left, so that no document is
cut into crumbs. What remains of the stream, less than one sequence, becomes
sequences whose lengths are powers of two, which need no padding.

Defined cases: a null text is empty; a document holds its end id at least, so
each has a piece; repeated rows are packed as often as they occur; a null id
is packed as any other; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import settle, utf8
from docferry.llm.tokens import WORD_RUNS, encoder

CAPACITY = 4096
LEAST_GAP = 16

ENCODED = "doc_id long, n_tokens long, part int, rest int, place long, first_whole long, ids binary"
PLACED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Pattern(NamedTuple):
    """``count`` packs of ``fill`` ids each, holding ``runs`` (length, copies)."""

    count: int
    fill: int
    runs: tuple[tuple[int, int], ...]


def shortest_pack_first(histogram: Mapping[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every length of ``histogram`` (length -> count)."""
    by_fill: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]

    def put(count: int, runs: tuple, fill: int, length: int, copies: int) -> None:
        if runs and runs[-1][0] == length:
            runs = runs[:-1] + ((length, runs[-1][1] + copies),)
        else:
            runs = (*runs, (length, copies))
        by_fill[fill + length * copies].append((count, runs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        fill = 0
        while left:
            last = capacity - length
            while fill <= last and not by_fill[fill]:
                fill += 1
            if fill > last:  # no pack has room: new ones take as many as they hold
                each = capacity // length
                full, some = divmod(left, each)
                if full:
                    put(full, (), 0, length, each)
                if some:
                    put(1, (), 0, length, some)
                break
            # All packs of this fill rise to the next fill there is.
            higher = next((f for f in range(fill + 1, last + 1) if by_fill[f]), last + 1)
            level, by_fill[fill] = by_fill[fill], []
            while level and left:
                count, runs = level.pop()
                copies = min(-(-(higher - fill) // length), (capacity - fill) // length, max(1, left // count))
                taken = min(count, left)
                if taken < count:
                    level.append((count - taken, runs))
                put(taken, runs, fill, length, copies)
                left -= taken * copies
            by_fill[fill] += level
    return [Pattern(count, fill, runs) for fill in range(capacity, 0, -1) for count, runs in by_fill[fill]]


class Layout(NamedTuple):
    """Where ranks go, as arrays sent to the tasks (their sizes depend on the
    capacity alone): places by (length, first rank), patterns, gaps and the
    boundaries of the last sequences."""

    capacity: int
    length: np.ndarray   # of each place, ascending, then by first rank
    first: np.ndarray
    copies: np.ndarray   # places of this length in one pack
    offset: np.ndarray   # of the first copy
    pattern: np.ndarray
    fill: np.ndarray     # by pattern
    base: np.ndarray     # first sequence of the pattern, or its first id in the stream
    loose: np.ndarray    # whether the pattern's packs are taken apart
    gap_start: np.ndarray  # of the gaps in the stream, by pattern with gaps, and their end
    gap: np.ndarray
    gap_fill: np.ndarray
    gap_base: np.ndarray
    tails: np.ndarray    # boundaries of the last sequences in the stream
    tail_base: int


def mend(patterns: list[Pattern], capacity: int, least_gap: int) -> tuple[list[Pattern], list[Pattern]]:
    """Split patterns into (kept, taken apart) so that the ids of the second,
    emptiest first, suffice for the gaps of the first, with less than one
    sequence over."""
    kept = sorted(patterns, key=lambda p: p.fill)

    def gap(p: Pattern) -> int:
        return capacity - p.fill if capacity - p.fill >= least_gap else 0

    lacking = sum(p.count * gap(p) for p in kept)
    loose: list[Pattern] = []
    while lacking > 0 and kept:
        p = kept[0]
        if not gap(p):
            break
        n = min(p.count, -(-lacking // (p.fill + gap(p))))
        loose.append(p._replace(count=n))
        lacking -= n * (p.fill + gap(p))
        if n < p.count:
            kept[0] = p._replace(count=p.count - n)
        else:
            kept.pop(0)
    return kept, loose


def lay_out(histogram: Mapping[int, int], capacity: int, least_gap: int) -> Layout:
    kept, loose = mend(shortest_pack_first(histogram, capacity), capacity, least_gap)
    fills, bases, gaps = [], [], []
    sequence = stream = filled = 0
    for p in kept:
        fills.append(p.fill)
        bases.append(sequence)
        if capacity - p.fill >= least_gap and loose:
            gaps.append((filled, capacity - p.fill, p.fill, sequence))
            filled += p.count * (capacity - p.fill)
        sequence += p.count
    for p in loose:
        fills.append(p.fill)
        bases.append(stream)
        stream += p.count * p.fill
    # What the gaps leave over: sequences as long as the binary digits of it.
    tails = [filled]
    for bit in reversed(range(max(0, stream - filled).bit_length())):
        if (stream - filled) >> bit & 1:
            tails.append(tails[-1] + (1 << bit))
    places = []
    taken: dict[int, int] = {}
    for k, p in enumerate(kept + loose):
        at = 0
        for length, copies in p.runs:
            first = taken.get(length, 0)
            places.append((length, first, copies, at, k))
            taken[length] = first + p.count * copies
            at += length * copies
    places.sort()
    columns = [np.array(c, np.int64) for c in zip(*places, strict=True)] or [np.zeros(0, np.int64)] * 5
    gap_columns = [np.array(c, np.int64) for c in zip(*gaps, strict=True)] or [np.zeros(0, np.int64)] * 4
    return Layout(capacity, *columns, np.array(fills, np.int64), np.array(bases, np.int64),
                  np.arange(len(fills)) >= len(kept), np.append(gap_columns[0], filled), *gap_columns[1:],
                  np.array(tails, np.int64), sequence)


def place(layout: Layout, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces of ``lengths`` with ``ranks``: (sequence, offset, loose); of
    loose ones the sequence is their first place in the stream."""
    # The last place of the length whose first rank isn't above the rank.
    low = np.searchsorted(layout.length, lengths, "left")
    high = np.searchsorted(layout.length, lengths, "right")
    while (wide := high - low > 1).any():
        middle = (low + high) // 2
        right = wide & (layout.first[np.minimum(middle, len(layout.first) - 1)] <= ranks)
        low = np.where(right, middle, low)
        high = np.where(wide & ~right, middle, high)
    within = ranks - layout.first[low]
    pack, copy = np.divmod(within, layout.copies[low])
    offset = layout.offset[low] + copy * lengths
    k = layout.pattern[low]
    loose = layout.loose[k]
    return np.where(loose, layout.base[k] + pack * layout.fill[k] + offset, layout.base[k] + pack), offset, loose


def cut_loose(layout: Layout, at: int, length: int) -> list[tuple[int, int, int]]:
    """(length, sequence, offset) of the pieces of a part of the stream."""
    out = []
    end, filled = at + length, int(layout.gap_start[-1])
    while at < end:
        if at < filled:
            j = int(np.searchsorted(layout.gap_start, at, "right")) - 1
            gap = int(layout.gap[j])
            pack, inside = divmod(at - int(layout.gap_start[j]), gap)
            n = min(gap - inside, end - at)
            out.append((n, int(layout.gap_base[j]) + pack, int(layout.gap_fill[j]) + inside))
        else:
            j = int(np.searchsorted(layout.tails, at, "right")) - 1
            n = min(int(layout.tails[j + 1]), end) - at
            out.append((n, layout.tail_base + j, at - int(layout.tails[j])))
        at += n
    return out


def encode(docs: DataFrame, *, tokenizer: str, cuts: str = WORD_RUNS, end_id: int = 2,
           capacity: int = CAPACITY) -> DataFrame:
    """Documents' ids (two bytes each where they fit), the length that is left
    beside whole pieces, the place among the task's pieces of that length, and
    the first sequence of the whole pieces: they count down from -1, from a
    number of the task's own."""
    end = struct.pack("<I", end_id)

    def run(batches):
        enc = encoder(tokenizer, cuts)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity, np.int64)
        next_whole = -1 - (part << 36)
        for batch in batches:
            tokens, rest, places, wholes, packed = [], [], [], [], []
            for text in utf8(batch.column(1)):
                ids = np.frombuffer(enc.encode(text) + end, "<u4")
                r = len(ids) % capacity
                tokens.append(len(ids))
                rest.append(r)
                places.append(int(seen[r]))
                seen[r] += 1
                wholes.append(next_whole)
                next_whole -= len(ids) // capacity
                packed.append(ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()), pa.array([part] * len(rest), pa.int32()),
                 pa.array(rest, pa.int32()), pa.array(places, pa.int64()), pa.array(wholes, pa.int64()),
                 pa.array(packed, pa.binary())],
                names=["doc_id", "n_tokens", "part", "rest", "place", "first_whole", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, ENCODED)


def pack(encoded: DataFrame, *, capacity: int = CAPACITY, least_gap: int = LEAST_GAP) -> DataFrame:
    """The pieces of ``encode``'s documents and their places in sequences."""
    encoded = settle(encoded, "encoded")
    counts = settle(encoded.filter("rest > 0").groupBy("part", "rest")
                    .agg((F.max("place") + 1).alias("n")), "lengths")
    # At most capacity - 1 rows.
    histogram = {r.rest: r.n for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    layout = lay_out(histogram, capacity, least_gap)
    # A length has one row for each partition here, not one for each piece.
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(batches):
        for batch in batches:
            rest = np.asarray(batch.column("rest"), np.int64)
            rank = np.asarray(batch.column("place"), np.int64) + np.asarray(batch.column("before"), np.int64)
            if len(layout.length):
                sequence, offset, loose = place(layout, np.where(rest > 0, rest, layout.length[0]),
                                                np.where(rest > 0, rank, 0))
            else:
                sequence = offset = loose = np.zeros(len(rest), np.int64)
            rows: list[tuple] = []
            whole = zip(batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist(),
                        batch.column("first_whole").to_pylist(), batch.column("ids").to_pylist(), rest.tolist(),
                        sequence.tolist(), offset.tolist(), loose.tolist(), strict=True)
            for doc_id, n, first_whole, ids, r, s, o, is_loose in whole:
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes() if len(ids) == 2 * n else ids
                pieces = [(capacity, first_whole - k, 0) for k in range(n // capacity)]
                if r:
                    pieces += cut_loose(layout, s, r) if is_loose else [(r, s, o)]
                at = 0
                for length, seq, off in pieces:
                    crc = zlib.crc32(memoryview(wide)[4 * at:4 * (at + length)])
                    rows.append((doc_id, at, length, crc, n, seq, off))
                    at += length
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=[f.split()[0] for f in PLACED.split(", ")])

    rows = encoded.join(offsets, ["part", "rest"], "left").select(
        "doc_id", "n_tokens", "rest", "place", F.coalesce("before", F.lit(0)).alias("before"),
        "first_whole", "ids")
    return rows.mapInArrow(run, PLACED)
