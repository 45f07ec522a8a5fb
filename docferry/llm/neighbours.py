"""Approximate nearest neighbours: multiprobe p-stable hashing.

``fit`` draws, for each of ``TABLES`` tables, ``HASHES`` Gaussian directions and
offsets; a vector's bucket is the tuple of ``floor((a.x + b) / w)``. The width
``w`` is ``WIDTH`` times the typical distance of a k-th neighbour, measured on
a sample of at most ``SAMPLE`` rows (the lowest hashes of their ids); the
largest norm is taken over all rows. ``index`` gives every row its buckets.

``search`` visits buckets in the order of their estimated success: a neighbour
at the typical distance falls in a bucket with the product, over the hash
functions, of normal probabilities; own and adjacent cells count. A query visits
buckets of a table until their probabilities add up to ``MASS``. The rows found
in any table are reranked by their exact inner product.

Largest inner products become nearest neighbours by one more coordinate,
``sqrt(M^2 - |x|^2)`` for rows and 0 for queries (M: the largest norm).

Rows are dealt to slices and queries to blocks by a hash of their ids, whatever
bucket they are in, so a vector that a third of all rows share is spread like
any other; a task holds one slice of the index and one block of queries and
gives each query's best in the slice, which one window per query merges. A
query that finds fewer than k rows is answered from all rows in the same way,
with every bucket visited, so it gets k whenever there are as many.

Defined cases: vectors null, empty, zero, of another length than most rows', or
with null or non-finite components take no part; ties go to the smaller id; a
row whose id is null takes no part; of rows with equal id one (by their values)
stays; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docferry.llm.common import settle

TABLES = 4
HASHES = 8
WIDTH = 1.8
MASS = 0.6
SAMPLE = 2_000
SLICE_ROWS = 4_096
LEAST_SLICES = 32
BLOCK_QUERIES = 2_048

_Phi = np.vectorize(lambda x: 0.5 * (1.0 + math.erf(x / math.sqrt(2.0))), otypes=[float])


@dataclass
class Model:
    directions: np.ndarray  # TABLES x (dim + 1) x HASHES
    offsets: np.ndarray  # TABLES x HASHES
    width: float
    distance: float
    norm: float

    def cells(self, x: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells (rows x tables x hashes) and the place within the cell."""
        z = np.einsum("nd,tdh->nth", np.column_stack([x, extra]), self.directions) + self.offsets
        cell = np.floor(z / self.width)
        return cell.astype(np.int64), z - cell * self.width


def bucket(cells: np.ndarray) -> np.ndarray:
    """One 64-bit number for each tuple of cells (8 bits a cell)."""
    return ((cells + 128) & 255) @ (256 ** np.arange(cells.shape[-1], dtype=np.int64))


def clean(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vec (double) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    ok = (F.col(id_column).isNotNull() & F.col(vector).isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
          & F.exists(v, lambda x: x != 0))
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vec"), ok.alias("ok")) \
        .filter("ok").drop("ok")
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    return rows


def fit(rows: DataFrame, k: int, seed: int = 1) -> Model | None:
    """Directions, width and norm for ``rows`` (vec_id, vec, all of one length)."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    n, largest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return None
    sample = (rows.select("vec", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id")
              .limit(SAMPLE).select("vec").toPandas())
    x = np.array(sample["vec"].tolist(), dtype=np.float64)
    x = np.column_stack([x, np.sqrt(np.maximum(0.0, largest ** 2 - (x ** 2).sum(axis=1)))])
    q = x[:256].copy()
    q[:, -1] = 0.0
    squares = (q ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1)[None] - 2 * q @ x.T
    squares[np.arange(len(q)), np.arange(len(q))] = np.inf
    near = np.sort(squares, axis=1)
    at = min(len(x) - 1, max(0, math.ceil(k / n * len(x)) - 1))
    distance = float(np.sqrt(np.median(near[:, min(at, near.shape[1] - 1)]))) if len(x) > 1 else 1.0
    distance = distance if np.isfinite(distance) and distance > 0 else max(1e-6, float(largest) or 1.0)
    rng = np.random.default_rng(seed)
    width = WIDTH * distance
    return Model(rng.normal(size=(TABLES, x.shape[1], HASHES)), rng.uniform(0, width, (TABLES, HASHES)),
                 width, distance, float(largest))


def probes(model: Model, cells: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Buckets of one table for one query, likeliest first, up to ``MASS``."""
    w, s, h = model.width, model.distance, len(cells)
    edges = _Phi(np.stack([-inside - w, -inside, w - inside, 2 * w - inside]) / s)
    p = np.diff(edges, axis=0)  # below, own, above
    p = np.maximum(p / p.sum(axis=0), 1e-12)
    items = sorted((math.log(p[1, j] / p[r, j]), j, r - 1) for j in range(h) for r in (0, 2))
    cost = [i[0] for i in items]
    own = float(np.prod(p[1]))
    home = int(bucket(cells))
    out, mass = [home], own
    heap = [(cost[0], (0,))]
    while mass < MASS and heap:
        c, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < len(items):
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], chosen[:-1] + (last + 1,)))
            heapq.heappush(heap, (c + cost[last + 1], chosen + (last + 1,)))
        if len({items[i][1] for i in chosen}) < len(chosen):
            continue
        moved = cells.copy()
        for i in chosen:
            moved[items[i][1]] += items[i][2]
        out.append(int(bucket(moved)))
        mass += own * math.exp(-c)
    return np.array(out, np.int64)


def index(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with their bucket in every table."""

    def add(batches):
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["vec"].tolist(), dtype=np.float64)
                extra = np.sqrt(np.maximum(0.0, model.norm ** 2 - (x ** 2).sum(axis=1)))
                pdf = pdf.assign(buckets=bucket(model.cells(x, extra)[0]).tolist())
                yield pdf

    return rows.mapInPandas(add, "vec_id long, vec array<double>, buckets array<long>")


def visits(queries: DataFrame, model: Model) -> DataFrame:
    """Queries with the buckets to visit, one list for each table."""

    def add(batches):
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["vec"].tolist(), dtype=np.float64)
                cells, inside = model.cells(x, np.zeros(len(x)))
                lists = [[probes(model, cells[i, t], inside[i, t]).tolist() for t in range(TABLES)]
                         for i in range(len(x))]
                yield pd.DataFrame({"query_id": pdf["vec_id"], "vec": pdf["vec"], "visits": lists})

    return queries.mapInPandas(add, "query_id long, vec array<double>, visits array<array<long>>")


FOUND = "query_id long, vec_id long, score double"


def scan(rows: DataFrame, queries: DataFrame, k: int, slices: int, blocks: int, *, all_buckets: bool = False) -> DataFrame:
    """Each query's k best visited rows of each slice."""

    def best(left, right):
        left, right = left.sort_values("vec_id"), right
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x = np.array(left["vec"].tolist(), dtype=np.float64)
        ids = left["vec_id"].to_numpy(np.int64)
        b = np.array(left["buckets"].tolist(), dtype=np.int64)
        local = [np.unique(b[:, t], return_inverse=True) for t in range(b.shape[1])]
        out = []
        for query, vec, lists in zip(right["query_id"], right["vec"], right["visits"], strict=True):
            if all_buckets:
                seen = ids != query
            else:
                seen = np.zeros(len(ids), bool)
                for (values, place), visited in zip(local, lists, strict=True):
                    seen |= np.isin(values, visited)[place]
                seen &= ids != query
            at = np.flatnonzero(seen)
            if len(at):
                # one sum for each row, in order of the components, whatever else is in the slice
                score = np.einsum("ij,j->i", x[at], np.asarray(vec, dtype=np.float64))
                top = np.lexsort((ids[at], -score))[:k]
                out.append((np.full(len(top), query, np.int64), ids[at][top], score[top]))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q, v, s = (np.concatenate(c) for c in zip(*out, strict=True))
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    left = rows.withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(slices))) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")) \
        .withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    return left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInPandas(best, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def search(df: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row of
    ``df`` (vec_id, embedding) that ``is_query`` marks."""
    spark = df.sparkSession
    rows = settle(clean(df), "vectors")
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sizes:
        return empty
    rows = rows.filter(F.size("vec") == sizes[0]["n"])
    model = fit(rows, k)
    indexed = settle(index(rows, model), "index")
    n = indexed.count()
    asked = settle(visits(indexed.filter(is_query).select("vec_id", "vec"), model), "queries")
    n_queries = asked.count()
    slices = max(LEAST_SLICES, -(-n // SLICE_ROWS))
    blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    found = settle(_top(scan(indexed, asked, k, slices, blocks), k), "found")
    # Queries with fewer than k rows visit every bucket.
    want = min(k, n - 1)
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= want).select("query_id")
    short = settle(asked.join(full, "query_id", "left_anti"), "short")
    if short.isEmpty():
        return found
    more = _top(scan(indexed, short, k, slices, max(1, -(-short.count() // BLOCK_QUERIES)), all_buckets=True), k)
    return found.join(short.select("query_id"), "query_id", "left_anti").unionByName(more)
