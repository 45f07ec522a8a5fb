"""Records of a partitioned stream once each, in offset order.

A broker delivers a partition's records at least once, and where several
writers or files feed one partition they may come out of order. Here each
partition is a key of a stateful operator (``transformWithStateInPandas``):

* state: the next offset, the number of records passed on, and the records
  that came before their turn (a map with one entry for each ``SPAN`` offsets,
  so that no value grows with a gap);
* a record below the next offset, or one already held, is a replay: dropped;
* records from the next offset on without a gap are passed on at once;
* a gap sets a processing-time timer. If it is still open after ``patience_ms``
  the offsets up to the smallest held record count as lost: that record is
  passed on with their number in ``skipped``. A lost record that comes later
  still is a replay.

State lives in the query's checkpoint: after a restart nothing is passed on
twice to a sink that replaces a repeated batch, as ``foreachBatch`` with the
batch id can. One partition is one order, so it is one task's work, as it is
one consumer's; parallelism is the number of partitions. Of a batch at most
``hold_rows`` records of a partition are in memory at once.

The operator's Python workers speak to the state store through protobuf, which
PySpark takes from the ``protobuf`` package.

Defined cases: records with a null partition or offset have no place in any
order and are left out (``decode`` rejects go to the dead letters before); null
values are kept; of different values for one offset in one batch any one is
kept; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "partition int, offset long, value binary, seq long, skipped long"

PATIENCE_MS = 600_000
HOLD_ROWS = 100_000
SPAN = 256  # offsets of one state entry

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """The state machine of one partition; see the module's text."""

    def __init__(self, start: int, patience_ms: int, hold_rows: int) -> None:
        self.start, self.patience_ms, self.hold_rows = start, patience_ms, hold_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "next long, seq long")
        self.gap = handle.getValueState("gap", "next long, timer long")
        self.held = handle.getMapState("held", "span long", "offsets array<long>, contents array<binary>")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        nxt, seq = self.place.get() or (self.start, 0)
        for block in _blocks(rows, self.hold_rows):
            block = block[block["offset"] >= nxt].drop_duplicates("offset").sort_values("offset")
            out: list = []
            for b, part in block.groupby(block["offset"] // SPAN):
                nxt = self._drain(nxt, int(b), out)
                nxt = self._take(int(b), dict(zip(part["offset"].tolist(), part["value"], strict=True)), nxt, out)
            nxt = self._drain(nxt, None, out)
            if out:
                yield self._frame(key, out, seq, 0)
                seq += len(out)
        self.place.update((nxt, seq))
        self._watch(nxt, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gap = self.gap.get()
        if gap is None or gap[1] != expiredTimerInfo.getExpiryTimeInMs():
            return  # the timer of a gap that has been closed
        self.gap.clear()
        nxt, seq = self.place.get()
        b = min(k[0] for k in self.held.keys())
        first = min(self.held.getValue((b,))[0])
        out: list = []
        after = self._drain(first, None, out)
        yield self._frame(key, out, seq, first - nxt)
        self.place.update((after, seq + len(out)))
        self._watch(after, timerValues)

    def _take(self, b: int, new: dict, nxt: int, out: list) -> int:
        """Add ``new`` records to the held ones of span ``b``, pass on those
        whose turn it is and hold the rest."""
        held = self.held.getValue((b,)) if self.held.containsKey((b,)) else None
        if held is not None:
            new.update(zip(held[0], held[1], strict=True))  # the first of two replays stays
        while nxt in new:
            out.append((nxt, new.pop(nxt)))
            nxt += 1
        if new:
            self.held.updateValue((b,), (list(new), list(new.values())))
        elif held is not None:
            self.held.removeKey((b,))
        return nxt

    def _drain(self, nxt: int, end: int | None, out: list) -> int:
        """Pass on held records from ``nxt`` on, up to the first gap or span ``end``."""
        while nxt // SPAN != end and self.held.containsKey((nxt // SPAN,)):
            before, nxt = nxt, self._take(nxt // SPAN, {}, nxt, out)
            if nxt // SPAN == before // SPAN:
                break
        return nxt

    def _watch(self, nxt: int, timers) -> None:
        """One timer for the gap at ``nxt``, set when that gap is first seen."""
        gap = self.gap.get()
        if gap is not None and gap[0] == nxt:
            return
        if gap is not None:
            self.handle.deleteTimer(gap[1])
            self.gap.clear()
        if self.held.exists():
            at = timers.getCurrentProcessingTimeInMs() + self.patience_ms
            self.handle.registerTimer(at)
            self.gap.update((nxt, at))

    @staticmethod
    def _frame(key, out: list, seq: int, skipped: int) -> pd.DataFrame:
        n = len(out)
        return pd.DataFrame({
            "partition": pd.Series([key[0]] * n, dtype="int32"),
            "offset": pd.Series([o for o, _ in out], dtype="int64"),
            "value": pd.Series([v for _, v in out], dtype="object"),
            "seq": pd.Series(range(seq, seq + n), dtype="int64"),
            "skipped": pd.Series([skipped] + [0] * (n - 1), dtype="int64")})


def _blocks(frames, rows: int) -> Iterator[pd.DataFrame]:
    held, n = [], 0
    for f in frames:
        held.append(f)
        n += len(f)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def in_order(records: DataFrame, *, start: int = 0, patience_ms: int = PATIENCE_MS,
             hold_rows: int = HOLD_ROWS) -> DataFrame:
    """Stream of (partition, offset, value) -> the same records once each, in
    offset order, with ``seq`` (the record's number in its partition's output)
    and ``skipped`` (lost offsets before it). Partitions begin at ``start``."""
    rows = records.where("partition IS NOT NULL AND offset IS NOT NULL").select(
        F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"),
        F.col("value").cast("binary").alias("value"))
    return rows.groupBy("partition").transformWithStateInPandas(
        InOrder(start, patience_ms, hold_rows), OUT, "Append", "ProcessingTime")


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None, *, wait_for_timers: bool = True):
    """Settings that a stateful query takes over when it is started: the state
    store that keeps maps and timers, and the number of state partitions
    (fixed by the first start of a checkpoint). Without ``wait_for_timers`` a
    run over what is there ends with the last record, its timers pending."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
              "spark.sql.streaming.noDataMicroBatches.enabled": str(wait_for_timers).lower()}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
