"""Token files of patched frame-of-reference blocks.

``write`` lays documents' ids out in ascending ``doc_id`` order, ``read`` gives
them back. One file is written for each range of ids, and a file is a sequence
of segments, each of at most ``SEGMENT_IDS`` ids or one document:

=============  ==========================================================
magic          ``PFR1`` and the segment's length in bytes (uint32)
counts         file number, first document's place in the file, documents,
               ids, blocks, exceptions (int64 each)
documents      doc_id (int64), 1 if the id is null (uint8), ids (int64)
block index    start of each block in the packed area (uint32), minimum
               (uint32), width (uint8), exceptions (uint16)
exceptions     place in the block (uint16) and value less minimum (uint32)
packed         ``id - minimum`` of each block of 1,024 ids, big-endian bits,
               all at the block's width (an exception's bits are its lowest)
end            one line feed
=============  ==========================================================

A block's width is that of one of the percentiles ``PERCENTILES`` of its
values, the one that makes the block smallest; larger values are exceptions.
All numbers are little-endian. The file is written by Spark's text writer (a
line is a segment), so it reaches any store that Spark writes to.

Defined cases: a null text is empty; every document ends with the end id, so
none has no ids; null ids come first; equal ids are ordered by text, equal rows
are all kept; an empty table gives no documents. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docferry.llm.common import scan_partitions, utf8
from docferry.llm.tokens import WORD_RUNS, encoder

SEGMENT_IDS = 1 << 19
BLOCK = 1024
PERCENTILES = (90, 97, 100)
MAGIC = b"PFR1"
HEAD = struct.Struct("<6q")


def pack_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes, int, int]:
    """Block index, exceptions and packed bytes of ids (uint32), with the
    numbers of blocks and exceptions."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    full = np.empty(blocks * BLOCK, dtype=np.uint32)
    full[:n] = ids
    full[n:] = ids[-1] if n else 0  # padding keeps the last block's range
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1) if blocks else np.zeros(0, np.uint32)
    delta = full - low[:, None]
    ordered = np.sort(delta, axis=1)
    best = np.zeros(blocks, np.int64)
    cost = np.full(blocks, np.iinfo(np.int64).max)
    for p in PERCENTILES:
        value = ordered[:, min(BLOCK - 1, BLOCK * p // 100)]
        width = np.ceil(np.log2(value.astype(np.float64) + 1)).astype(np.int64)
        beyond = (delta >> width[:, None].astype(np.uint32) > 0).sum(axis=1)
        bits = width * BLOCK + beyond * 48
        best, cost = np.where(bits < cost, width, best), np.minimum(bits, cost)
    beyond = delta >> best[:, None].astype(np.uint32) > 0
    at = np.nonzero(beyond)
    exceptions = at[1].astype("<u2").tobytes() + delta[beyond].astype("<u4").tobytes()
    packed: list[bytes] = [b""] * blocks
    for width in np.unique(best):
        chosen = np.flatnonzero(best == width)
        if width == 0:
            continue
        big = delta[chosen].astype(">u4").view(np.uint8).reshape(len(chosen), BLOCK, 4)
        take = -(-int(width) // 8)  # only the bytes that hold the width
        bits = np.unpackbits(big[:, :, 4 - take:], axis=2)[:, :, 8 * take - int(width):]
        rows = np.packbits(bits.reshape(len(chosen), -1), axis=1)
        for i, row in zip(chosen.tolist(), rows, strict=True):
            packed[i] = row.tobytes()
    starts = np.cumsum([0, *map(len, packed[:-1])]) if blocks else np.zeros(0)
    index = starts.astype("<u4").tobytes() + low.astype("<u4").tobytes() \
        + best.astype(np.uint8).tobytes() + beyond.sum(axis=1).astype("<u2").tobytes()
    return index, exceptions, b"".join(packed), blocks, len(at[0])


def unpack_ids(n: int, blocks: int, exceptions: int, index: bytes, more: bytes,
               packed: bytes) -> np.ndarray:
    starts, low = np.frombuffer(index[:8 * blocks], "<u4").reshape(2, blocks).astype(np.int64)
    widths = np.frombuffer(index[8 * blocks:9 * blocks], np.uint8)
    beyond = np.frombuffer(index[9 * blocks:], "<u2").astype(np.int64)
    place = np.frombuffer(more[:2 * exceptions], "<u2").astype(np.int64)
    value = np.frombuffer(more[2 * exceptions:], "<u4")
    area = np.frombuffer(packed, np.uint8)
    out = np.zeros((blocks, BLOCK), np.uint32)
    for width in np.unique(widths):
        if width == 0:
            continue
        chosen = np.flatnonzero(widths == width)
        size = BLOCK // 8 * int(width)
        rows = area[starts[chosen][:, None] + np.arange(size)]
        bits = np.unpackbits(rows, axis=1).reshape(len(chosen), BLOCK, int(width))
        take = -(-int(width) // 8)
        padded = np.zeros((len(chosen), BLOCK, 8 * take), np.uint8)
        padded[:, :, 8 * take - int(width):] = bits
        whole = np.zeros((len(chosen), BLOCK, 4), np.uint8)
        whole[:, :, 4 - take:] = np.packbits(padded, axis=2)
        out[chosen] = whole.view(">u4")[:, :, 0]
    out[np.repeat(np.arange(blocks), beyond), place] = value
    return (out + low[:, None].astype(np.uint32)).reshape(-1)[:n]


def segment(part: int, first: int, doc_ids: list, lengths: list[int], ids: bytes) -> bytes:
    values = np.frombuffer(ids, "<u4")
    index, more, packed, blocks, exceptions = pack_ids(values)
    body = b"".join((
        HEAD.pack(part, first, len(doc_ids), len(values), blocks, exceptions),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<i8").tobytes(), index, more, packed))
    return MAGIC + struct.pack("<I", len(body)) + body


def segments(data: bytes) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """(file number, first place, doc_ids, lengths, ids) of each segment."""
    at = 0
    while at < len(data):
        if data[at:at + 4] != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        size = struct.unpack_from("<I", data, at + 4)[0]
        body = data[at + 8:at + 8 + size]
        if len(body) != size or data[at + 8 + size:at + 9 + size] != b"\n":
            raise ValueError(f"cut segment at byte {at}")
        part, first, docs, n, blocks, exceptions = HEAD.unpack_from(body)
        p = HEAD.size
        raw = np.frombuffer(body[p:p + 8 * docs], "<i8").tolist()
        gone = np.frombuffer(body[p + 8 * docs:p + 9 * docs], np.uint8)
        lengths = np.frombuffer(body[p + 9 * docs:p + 17 * docs], "<i8")
        p += 17 * docs
        e = p + 11 * blocks
        f = e + 6 * exceptions
        ids = unpack_ids(n, blocks, exceptions, body[p:e], body[e:f], body[f:])
        yield part, first, [None if g else d for d, g in zip(raw, gone, strict=True)], lengths, ids
        at += 9 + size


def write(docs: DataFrame, path: str, *, tokenizer: str, cuts: str = WORD_RUNS,
          end_id: int = 2, files: int | None = None) -> None:
    """Encode ``text`` of every document and write the files to ``path``.

    ``files`` is the number of id ranges, by default as many as there are tasks
    that scan the table, so a file follows the size of a scan split.
    """
    end = struct.pack("<I", end_id)

    def encode(batches):
        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer, cuts)
        ids, lengths, chunks, held, first = [], [], [], 0, 0

        def flush():
            line = segment(part, first, ids, lengths, b"".join(chunks))
            raw = pa.array([line], pa.binary())
            return pa.RecordBatch.from_arrays([raw], names=["line"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                coded = enc.encode(text) + end
                if ids and held + len(coded) // 4 > SEGMENT_IDS:
                    yield flush()
                    first += len(ids)
                    ids, lengths, chunks, held = [], [], [], 0
                ids.append(doc_id)
                lengths.append(len(coded) // 4)
                chunks.append(coded)
                held += len(coded) // 4
        if ids:
            yield flush()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .repartitionByRange(files or scan_partitions(docs), "doc_id")
     .sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, "line binary")
     # cast() of binary keeps the bytes as they are, and so does the writer
     .select(F.col("line").cast("string").alias("value"))
     .write.text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files: doc_id, start, n_tokens,
    ids_crc32, part (file number)."""

    def decode(batches):
        for batch in batches:
            for data in batch.column(0):
                at = 0
                for part, _, doc_ids, lengths, ids in segments(data.as_buffer().to_pybytes()):
                    raw = ids.astype("<u4").tobytes()
                    ends = np.cumsum(lengths)
                    begins = ends - lengths
                    crc = [zlib.crc32(raw[4 * b:4 * e]) for b, e in
                           zip(begins.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(begins + at, pa.int64()),
                         pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64()),
                         pa.array([part] * len(doc_ids), pa.int64())],
                        names=["doc_id", "within", "n_tokens", "ids_crc32", "part"])
                    at += int(lengths.sum())

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(decode, "doc_id long, within long, n_tokens long, ids_crc32 long, part long")


def with_starts(rows: DataFrame) -> DataFrame:
    """``start``: ids of all documents before, from one total for each file."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "part")
