"""Ranges of like bytes over a sort key, from a mergeable quantile sketch.

``order_key`` makes one text of several columns that sorts as they do.
``byte_splitters`` reads (key, size) once: every task keeps a bounded summary of
its keys weighted by their bytes, summaries are merged in a tree of bounded
groups, and the last one gives the keys at which the bytes reach each multiple
of a range's share. A summary of ``m`` entries hides at most ``1/m`` of the
bytes it stands for, at random places, so errors of many tasks even out; each
level of the tree adds as much again.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRIES = 8192
FAN_IN = 64
_SIGN = -(1 << 63)


def order_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """One text that sorts as ``columns`` do (null first): a mark of presence
    and hex digits for each, parted by a character below all digits."""
    parts = []
    for name in columns:
        c, dt = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(dt, T.StringType):
            digits = F.hex(c.cast("binary"))
        elif isinstance(dt, T.BinaryType):
            digits = F.hex(c)
        else:
            if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
                n = c.cast("bigint")
            elif isinstance(dt, T.TimestampType):
                n = F.unix_micros(c)
            elif isinstance(dt, T.TimestampNTZType):
                n = F.unix_micros(c.cast("timestamp"))
            elif isinstance(dt, T.DateType):
                n = F.unix_date(c).cast("bigint")
            else:
                raise ValueError(f"cannot order by {name} of type {dt.simpleString()}")
            digits = F.lpad(F.hex(n.bitwiseXOR(F.lit(_SIGN))), 16, "0")
        parts.append(F.coalesce(F.concat(F.lit("1"), digits), F.lit("0")))
    return F.concat_ws(" ", *parts)


def compress(keys: pa.Array, sizes: np.ndarray, entries: int, shift: float) -> tuple[pa.Array, np.ndarray]:
    """A summary of at most ``entries`` weighted keys, sorted. ``shift`` (0 to
    1) places the marks; a random one makes errors of many summaries cancel."""
    order = pc.sort_indices(keys)
    keys, sizes = keys.take(order), sizes[order.to_numpy()]
    if len(keys) <= entries:
        return keys, sizes
    total = sizes.sum()
    reached = np.cumsum(sizes)
    marks = (np.arange(entries) + shift) * (total / entries)
    at = np.minimum(np.searchsorted(reached, marks, "right"), len(keys) - 1)
    return keys.take(pa.array(at)), np.full(entries, total / entries)


class Sizes(NamedTuple):
    """Bytes and rows of all lines, and the first keys of the ranges but the first."""

    size: int
    rows: int
    splitters: list[str]


def byte_splitters(rows: DataFrame, target: int, *, entries: int = ENTRIES) -> Sizes:
    """Splitters for ranges of about ``target`` bytes; ``rows``: key, size."""
    if target <= 0:
        raise ValueError("target bytes must be positive")

    def summarise(batches):
        part = TaskContext.get().partitionId()
        rng = np.random.default_rng(part)
        keys, sizes = pa.array([], pa.string()), np.zeros(0)
        total = n = 0
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            total, n = total + int(own.sum()), n + len(own)
            keys = pa.concat_arrays([keys, batch.column(0).cast(pa.string())])
            sizes = np.concatenate([sizes, own])
            if len(keys) > 4 * entries:
                keys, sizes = compress(keys, sizes, entries, rng.random())
        keys, sizes = compress(keys, sizes, entries, rng.random())
        if n:
            first = np.zeros(len(keys), np.int64)
            all_sizes, all_rows = first.copy(), first.copy()
            all_sizes[0], all_rows[0] = total, n
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(keys), pa.int32()), keys, pa.array(sizes), pa.array(all_sizes),
                 pa.array(all_rows)], names=["part", "key", "weight", "size", "n"])

    schema = "part int, key string, weight double, size long, n long"

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0]) // FAN_IN
        keys, weights = compress(pa.array(pdf["key"], pa.string()), pdf["weight"].to_numpy(), entries,
                                 np.random.default_rng(part).random())
        out = pd.DataFrame({"part": np.int32(part), "key": keys.to_pandas(), "weight": weights, "size": 0, "n": 0})
        out.loc[0, ["size", "n"]] = [int(pdf["size"].sum()), int(pdf["n"].sum())]
        return out

    tasks = rows.rdd.getNumPartitions()
    found = rows.select("key", "size").mapInArrow(summarise, schema)
    while tasks > 1:
        found = found.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(merge, schema)
        tasks = -(-tasks // FAN_IN)
    # One summary: at most ``entries`` rows.
    summary = found.toPandas().sort_values("key", kind="stable")
    size, n = int(summary["size"].sum()), int(summary["n"].sum())
    ranges = max(1, -(-size // target))
    reached = summary["weight"].cumsum().to_numpy()
    at = np.searchsorted(reached, np.arange(1, ranges) * (reached[-1] / ranges), "left") if len(reached) else []
    keys = summary["key"].tolist()
    return Sizes(size, n, sorted({keys[min(i + 1, len(keys) - 1)] for i in at}))


def range_of(key: Column, splitters: Sequence[str], df: DataFrame) -> Column:
    """Number of the range that holds ``key`` (only keys go to Python)."""
    shared = df.sparkSession.sparkContext.broadcast(list(splitters))

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        cuts = shared.value
        return pd.Series([bisect_right(cuts, k) for k in keys], dtype="int32")

    return find(key)
