"""Records of shuffled, repeated and lost offsets come out once, in order."""

from __future__ import annotations

import random
import time

from docferry.streaming.in_order import in_order, state_settings

SCHEMA = "value binary, partition int, offset long, note string"


def _drop(spark, path, i, records):
    spark.createDataFrame([(v, p, o, "x") for p, o, v in records], SCHEMA).coalesce(1).write.parquet(f"{path}/file={i}")


def _start(spark, src, out, ckpt, *, trigger=None, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(src)

    def write(batch, epoch):
        # A batch that is run again replaces what it wrote before.
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    with state_settings(spark, 2, wait_for_timers=trigger is None):
        return (in_order(stream, **options).writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
                .trigger(**(trigger or {"processingTime": "0 seconds"})).start())


def _result(spark, out):
    found = {}
    for r in spark.read.parquet(out).orderBy("partition", "epoch", "seq").collect():
        found.setdefault(r.partition, []).append((r.seq, r.offset, r.value and bytes(r.value), r.skipped))
    return found


def test_shuffled_and_repeated_over_a_restart(spark, out_dir):
    rng = random.Random(1)
    records = [(p, o, None if o == 5 else b"%d-%d" % (p, o)) for p in range(3) for o in range(40 if p else 600)]
    dealt = records + rng.sample(records, 200) + [(None, 1, b"a"), (1, None, b"b")]
    rng.shuffle(dealt)
    src, out, ckpt = (f"{out_dir}/{x}" for x in ("src", "out", "ckpt"))
    for run, part in enumerate((dealt[:400], dealt[400:])):
        for i in range(3):
            _drop(spark, src, 3 * run + i, part[i::3])
        query = _start(spark, src, out, ckpt, trigger={"availableNow": True}, hold_rows=70)
        assert query.awaitTermination(240)
    found = _result(spark, out)
    assert found == {p: [(o, o, v, 0) for q, o, v in records if q == p] for p in range(3)}


def test_lost_offset_is_skipped_after_its_time(spark, out_dir):
    src, out, ckpt = (f"{out_dir}/{x}" for x in ("src", "out", "ckpt"))
    _drop(spark, src, 0, [(0, 7, b"7"), (0, 4, b"4"), (0, 6, b"6"), (0, 3, b"3")])
    query = _start(spark, src, out, ckpt, start=2, patience_ms=1500)

    def wait(offset):
        end = time.time() + 120
        while time.time() < end and query.isActive:
            try:
                if offset in [o for _, o, _, _ in _result(spark, out).get(0, [])]:
                    return
            except Exception:  # nothing written yet
                pass
            time.sleep(0.5)
        raise AssertionError(query.exception())

    try:
        wait(7)
        # What was given up is a replay; the next in order goes on.
        _drop(spark, src, 1, [(0, 2, b"late"), (0, 8, b"8")])
        wait(8)
    finally:
        query.stop()
    assert _result(spark, out)[0] == [(0, 3, b"3", 1), (1, 4, b"4", 0), (2, 6, b"6", 1), (3, 7, b"7", 0), (4, 8, b"8", 0)]
