"""Total order, keyset pages and page numbers (K1-K5).

* ``keyset_page``: the next ``size`` rows strictly after a key, in key
  order — one filtered top-k (Spark plans ``TakeOrderedAndProject``: each
  task keeps its own ``size`` best rows, nothing else is shuffled).
* ``iter_pages``: the source system's cursor loop, page after page, ending on
  the first empty page.
* ``with_row_index`` / ``page_numbers``: a global position for every row
  without a single-partition window: range-sort, count rows per sorted
  partition, turn the counts into offsets (one row per partition), add.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33  # monotonically_increasing_id: partition index above, position below


def _after(keys: Sequence[str], last: Sequence[Any]) -> Column:
    """(k1, k2, ...) > (a1, a2, ...) in lexicographic order."""
    if len(keys) != len(last):
        raise ValueError("cursor and keys differ in length")
    cond = None
    for i in range(len(keys) - 1, -1, -1):
        gt = F.col(keys[i]) > F.lit(last[i])
        cond = gt if cond is None else (gt | ((F.col(keys[i]) == F.lit(last[i])) & cond))
    return cond


def keyset_page(df: DataFrame, keys: Sequence[str], size: int,
                after: Sequence[Any] | None = None) -> DataFrame:
    """K2: rows strictly after ``after`` (all rows when None), first ``size``."""
    if size <= 0:
        raise ValueError("page size must be positive")
    src = df if after is None else df.where(_after(keys, after))
    return src.orderBy(*keys).limit(size)


def iter_pages(df: DataFrame, keys: Sequence[str], size: int) -> Iterator[list]:
    """K2/K3 driver loop: yield each page's rows until an empty page.

    Each page is one bounded top-k job; the cursor is the last row's key, so
    the keys must be unique and never null: a null key, or a row beyond the
    page with the last row's key, raises ``ValueError`` before the page is
    given. For whole-table exports use the partitioned writers instead.
    """
    after = None
    while True:
        rows = keyset_page(df, keys, size + 1, after).collect()
        if not rows:
            return
        found = [tuple(r[k] for k in keys) for r in rows]
        if any(v is None for key in found for v in key):
            raise ValueError(f"a row has no value for one of the keys {list(keys)}")
        if len(set(found)) < len(found):
            raise ValueError(f"the keys {list(keys)} aren't unique")
        yield rows[:size]
        if len(rows) <= size:
            return
        after = list(found[size - 1])


def with_row_index(df: DataFrame, keys: Sequence[str], name: str = "row_index") -> DataFrame:
    """K1 + K4: 0-based position of every row in ``keys`` order.

    The sorted frame is checkpointed (to the cluster's checkpoint folder), so
    the per-partition counts and the final rows see the same assignment even
    if an executor is lost between the two passes.
    """
    from docferry.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    sorted_df = df.orderBy(*keys).withColumn("__mid", F.monotonically_increasing_id())
    sorted_df = sorted_df.checkpoint(eager=True)
    part = F.shiftright(F.col("__mid"), _POS_BITS)
    pos = F.col("__mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = sorted_df.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    # ``offsets`` has one row per partition of the sort: a bounded broadcast.
    return (sorted_df.join(F.broadcast(offsets), part == F.col("__part"))
            .withColumn(name, F.col("__off") + pos)
            .drop("__mid", "__part", "__off"))


def page_numbers(df: DataFrame, keys: Sequence[str], size: int, name: str = "page") -> DataFrame:
    """K4: page of each row (0-based) for pages of ``size`` rows in key order."""
    if size <= 0:
        raise ValueError("page size must be positive")
    indexed = with_row_index(df, keys, "__idx")
    return indexed.withColumn(name, F.floor(F.col("__idx") / F.lit(size)).cast("bigint")).drop("__idx")


def page_index(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """K2: (page, keys): the first key of each page of ``size`` rows, from one
    range sort. A page is then a range of keys (``read_page``), so no page needs
    those before it. The keys must be unique."""
    if size <= 0:
        raise ValueError("page size must be positive")
    indexed = with_row_index(df.select(*keys), keys, "__idx")
    return indexed.filter(F.col("__idx") % size == 0).select(
        F.floor(F.col("__idx") / F.lit(size)).cast("bigint").alias("page"), *keys)


def read_page(df: DataFrame, keys: Sequence[str], index: DataFrame, page: int) -> DataFrame:
    """K2, K3: one page, as a filter on the keys that reaches the scan; empty
    beyond the last page. The driver gets two rows of the index."""
    bounds = {r["page"]: [r[k] for k in keys] for r in index.filter(F.col("page").isin([page, page + 1])).collect()}
    if page not in bounds:
        return df.limit(0)
    first = bounds[page]
    here = _after(keys, first)
    for k, v in zip(keys, first, strict=True):
        same = F.col(k) == F.lit(v) if k == keys[0] else same & (F.col(k) == F.lit(v))
    # Bounds of the leading key alone, which files have statistics for.
    here = (F.col(keys[0]) >= F.lit(first[0])) & (here | same)
    if page + 1 in bounds:
        following = bounds[page + 1]
        for k, v in zip(keys, following, strict=True):
            same = F.col(k) == F.lit(v) if k == keys[0] else same & (F.col(k) == F.lit(v))
        here = here & (F.col(keys[0]) <= F.lit(following[0])) & ~(_after(keys, following) | same)
    return df.where(here).orderBy(*keys)


def preview(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """K5: the first ``n`` rows in key order (a top-k, not a full sort)."""
    return df.orderBy(*keys).limit(n)
