"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
import weakref
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.session import checkpoint_dir, ship  # noqa: F401
from docferry.sources import fs

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SETTLED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_IN_USE: list[dict] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of this application."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder as Parquet and read it back:
    cuts the lineage, so that neither a later job nor a lost executor makes
    Spark run the steps above it again. What was shuffled for it is deleted
    with the end of the write, not when the driver collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    _SETTLED[out] = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a table that ``settle`` wrote, once no later step
    reads it: what was made of it must be written, too."""
    fs.delete(df.sparkSession, _SETTLED.pop(df))


def sole(cache: dict) -> dict:
    """``cache``, after the one that this worker process used before is emptied.
    Workers outlive an operator, and the memory of each of its caches would add
    to that of the next one's."""
    if _IN_USE and _IN_USE[0] is not cache:
        _IN_USE.pop().clear()
    if not _IN_USE:
        _IN_USE.append(cache)
    return cache


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` begins with it (Spark
    compares names without case)."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def scan_partitions(df: DataFrame) -> int:
    """Tasks that read ``df`` (its own partitioning; no job runs)."""
    return max(1, df.rdd.getNumPartitions())


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8(column: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def longs(column: pa.Array) -> list:
    return column.to_pylist()


def crc_mod(id_column, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % F.lit(modulus)


def crc_mod_py(value, modulus: int) -> int:
    return zlib.crc32(str(value).encode()) % modulus if value is not None else -1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
