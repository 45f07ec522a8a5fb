"""Quartile bucket digests of documents.

A text's UTF-8 byte triplets are hashed to 256 buckets and counted; a bucket's
code (0 to 3) says between which quartiles of the 256 counts its count lies.
The digest is ``Q1``, a length code (logarithm to base 1.1, one byte) and the
codes, in hex. Two digests differ by the sum over buckets of the codes'
distance (opposite ends count 6), plus 8 for each step of the length code, up
to 24 steps; ``likeness`` is 1 less that sum over its largest value.

``with_next`` pairs every document with the next one in descending doc_id order
(after the last: the first): texts are range-partitioned and sorted once, a
task compares neighbours as they stream by, and only the first and last text of
each task go on to a second, small step that closes the gaps between tasks.

Defined cases: a null text is empty; texts of less than three bytes have no
triplets and all codes 0; null ids come last, equal ids in order of their
texts; a table's only row is its own next; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docferry.llm.common import mix64, scan_partitions, settle, utf8

BUCKETS = 256
LENGTH_BASE = 1.1
LENGTH_STEPS = 24
LENGTH_WEIGHT = 8
OPPOSITE = 6
LARGEST = BUCKETS * OPPOSITE + LENGTH_STEPS * LENGTH_WEIGHT

_TABLES = (mix64(np.arange(3 * 256, dtype=np.uint64) + np.uint64(1)) & np.uint64(255)).astype(np.uint8).reshape(3, 256)


def codes(data: bytes) -> tuple[int, np.ndarray]:
    """Length code and bucket codes of a text's bytes."""
    length = min(255, int(np.log(len(data) + 1) / np.log(LENGTH_BASE)))
    if len(data) < 3:
        return length, np.zeros(BUCKETS, np.uint8)
    b = np.frombuffer(data, np.uint8)
    counts = np.bincount(_TABLES[0][b[:-2]] ^ _TABLES[1][b[1:-1]] ^ _TABLES[2][b[2:]], minlength=BUCKETS)
    ordered = np.sort(counts)
    q = ordered[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    return length, (counts[:, None] > q).sum(axis=1).astype(np.uint8)


def digest(data: bytes) -> str:
    length, c = codes(data)
    packed = c.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    return f"Q1{length:02x}" + packed.astype(np.uint8).tobytes().hex()


def parse(text: str) -> tuple[int, np.ndarray]:
    packed = np.frombuffer(bytes.fromhex(text[4:]), np.uint8)
    return int(text[2:4], 16), ((packed[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).reshape(-1)


_APART = np.array([0, 1, 2, OPPOSITE])


def difference(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> int:
    """Bounded difference score of two digests, 0 to ``LARGEST``."""
    apart = np.abs(a[1].astype(np.int8) - b[1].astype(np.int8))
    return int(_APART[apart].sum()) + LENGTH_WEIGHT * min(LENGTH_STEPS, abs(a[0] - b[0]))


def likeness(a, b) -> float:
    return 1.0 - difference(a, b) / LARGEST


def edited(text: str, following: str) -> str:
    """``text`` with its last half (code points, rounded down) replaced by the
    first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _row(doc_id, text: str, own, next_text: str, next_codes) -> tuple:
    changed = edited(text, next_text).encode()
    other = codes(changed)
    return (doc_id, len(text), hashlib.sha256(changed).hexdigest(), _hex(own), _hex(other),
            likeness(own, other), likeness(own, next_codes))


def _hex(c) -> str:
    packed = c[1].reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    return f"Q1{c[0]:02x}" + packed.astype(np.uint8).tobytes().hex()


def _batch(rows: list[tuple], kinds, names) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def with_next(docs: DataFrame) -> DataFrame:
    """Digest, edited digest and likenesses of every document (see ``OUT``)."""
    names = [f.split()[0] for f in OUT.split(", ")]
    wide = OUT + ", part int, edge string, text string"

    def stream(batches):
        part = TaskContext.get().partitionId()
        kinds = (*_KINDS, pa.int32(), pa.string(), pa.string())
        held = None
        for batch in batches:
            out = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                text, own = raw.decode("utf-8", "replace"), codes(raw)
                if held is None:
                    out.append((doc_id, *[None] * 6, part, "first", text))
                else:
                    out.append((*_row(*held, text, own), part, None, None))
                held = (doc_id, text, own)
            yield _batch(out, kinds, [*names, "part", "edge", "text"])
        if held is not None:
            yield _batch([(held[0], *[None] * 6, part, "last", held[1])], kinds, [*names, "part", "edge", "text"])

    order = F.col("doc_id").desc_nulls_last()
    done = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(scan_partitions(docs), order)
        .sortWithinPartitions(order, F.col("text").asc_nulls_first())
        .mapInArrow(stream, wide), "digests")
    # Two rows for each task: the last text of a task meets the first text of
    # the next task that has rows (after the last task: of the first one).
    edges = done.filter("edge IS NOT NULL").select("part", "edge", "doc_id", "text")
    firsts = edges.filter("edge = 'first'").select(F.col("part").alias("p"), F.col("text").alias("next_text"))
    tasks = firsts.select("p").withColumn("next_p", F.coalesce(
        F.lead("p").over(W.orderBy("p")),
        F.min("p").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    lasts = edges.filter("edge = 'last'").select("part", "doc_id", "text")
    pairs = (lasts.join(tasks, lasts["part"] == tasks["p"]).drop("p")
             .join(firsts, F.col("next_p") == firsts["p"]).select("doc_id", "text", "next_text"))

    def close(batches):
        for batch in batches:
            out = []
            for doc_id, a, b in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), utf8(batch.column(2)),
                                    strict=True):
                out.append(_row(doc_id, a.decode("utf-8", "replace"), codes(a), b.decode("utf-8", "replace"), codes(b)))
            yield _batch(out, _KINDS, names)

    return done.filter("edge IS NULL").select(*names).unionByName(pairs.mapInArrow(close, OUT))
