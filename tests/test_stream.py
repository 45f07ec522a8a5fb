"""Control stream, failing batch, restart, replay."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest

from docferry.sources.tables import driver_catalog
from docferry.plans.job_run import RunOptions
from docferry.streaming.control_stream import StreamConfig, file_control_source, start

from helpers import SMALL

JOB = {"data_index": "customer", "query": {"term": {"c_mktsegment": "BUILDING"}},
       "columns": ["c_custkey", "name"], "column_paths": {"name": "c_name"},
       "remote_filename": "exp/customers.csv"}


def _drop(spark, path, i, value):
    df = spark.createDataFrame([(value, 0, i)], "value binary, partition int, offset long")
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={i:03d}")


def _run(spark, cfg, src, ckpt):
    q = start(spark, file_control_source(spark, src), cfg, checkpoint=ckpt)
    err = None
    try:
        q.awaitTermination(120)
    except Exception as e:  # the query stopped on a failing batch
        err = e
    finally:
        if q.isActive:
            q.stop()
    return err


def test_fail_restart_replay(spark, out_dir):
    src, ckpt = f"{out_dir}/ctl", f"{out_dir}/ckpt"
    os.makedirs(src)
    jobs = {"a": JOB}
    cat = driver_catalog(spark, SMALL)

    def job_table():
        return spark.createDataFrame([(k, json.dumps(v)) for k, v in jobs.items()], "_id string, doc string")

    cfg = StreamConfig(jobs=job_table, catalog=cat,
                       options=RunOptions(staging_root=f"{out_dir}/stage", publish_root=f"{out_dir}/pub"),
                       ledger_path=f"{out_dir}/ledger", dead_letter_path=f"{out_dir}/dead",
                       clock=lambda: datetime(2024, 1, 31))
    values = [b'{"job_doc_id": "a"}', b"not json", None, b'{"job_doc_id": "b"}', b'{"id": "a"}']
    for i, v in enumerate(values):
        # File sources read files in name order within a directory tree.
        _drop(spark, src, i, v)
    # Batch 4 names job "b", which does not exist yet: the query stops there.
    err = _run(spark, cfg, src, ckpt)
    assert err is not None and "not_found" in str(err)
    ledger = spark.read.parquet(cfg.ledger_path)
    assert sorted(r.offset for r in ledger.collect()) == [0]
    dead = sorted((r.offset, r.error) for r in spark.read.parquet(cfg.dead_letter_path).collect())
    assert dead == [(1, "undecodable"), (2, "null_value")]
    # Fix the job table and restart: batch 4 is replayed, then batch 5 runs.
    jobs["b"] = dict(JOB, remote_filename="exp/b.csv")
    assert _run(spark, cfg, src, ckpt) is None
    ledger = spark.read.parquet(cfg.ledger_path)
    assert sorted(r.offset for r in ledger.collect()) == [0, 3, 4]
    expected = (spark.read.parquet(f"{SMALL}/customer.parquet").where("c_mktsegment = 'BUILDING'").count())
    assert {r.row_count for r in ledger.collect()} == {expected}
    assert os.path.exists(f"{out_dir}/pub/exp/b.csv.sha256")
    # A third run has nothing left to do.
    assert _run(spark, cfg, src, ckpt) is None
    assert spark.read.parquet(cfg.ledger_path).count() == 3
    dead = spark.read.parquet(cfg.dead_letter_path).count()
    assert dead == 2


def test_relaxed_order_batch_one_scan(spark, out_dir):
    from docferry.streaming.control_stream import process_batch

    cat = driver_catalog(spark, SMALL)
    jobs = {"a": JOB, "b": dict(JOB, query={"term": {"c_mktsegment": "MACHINERY"}},
                                remote_filename="exp/m.csv")}

    def job_table():
        return spark.createDataFrame([(k, json.dumps(v)) for k, v in jobs.items()], "_id string, doc string")

    cfg = StreamConfig(jobs=job_table, catalog=cat,
                       options=RunOptions(staging_root=f"{out_dir}/stage", publish_root=f"{out_dir}/pub"),
                       ledger_path=f"{out_dir}/ledger", dead_letter_path=f"{out_dir}/dead",
                       clock=lambda: datetime(2024, 1, 31), strict_order=False)
    batch = spark.createDataFrame(
        [(b'{"job_doc_id": "a"}', 0, 0), (b'{"job_doc_id": "b"}', 0, 1), (b"oops", 0, 2),
         (b'{"id": "a"}', 1, 0)], "value binary, partition int, offset long")
    process_batch(spark, batch, 0, cfg)
    ledger = sorted((r.partition, r.offset, r.job_id) for r in spark.read.parquet(cfg.ledger_path).collect())
    assert [x[:2] for x in ledger] == [(0, 0), (0, 1), (1, 0)]
    cust = spark.read.parquet(f"{SMALL}/customer.parquet")
    rows = {r.job_id: r.row_count for r in spark.read.parquet(cfg.ledger_path).collect()}
    assert rows["b"] == cust.where("c_mktsegment = 'MACHINERY'").count()
    # Replaying the batch skips what the ledger holds.
    process_batch(spark, batch, 0, cfg)
    assert spark.read.parquet(cfg.ledger_path).count() == 3


def test_graceful_stop_between_records(spark, out_dir):
    from docferry.streaming.control_stream import StopRequested, process_batch

    cat = driver_catalog(spark, SMALL)
    jobs = {"a": JOB}
    calls = {"n": 0}

    def stop():
        calls["n"] += 1
        return calls["n"] > 1  # let the first record finish, stop before the second

    cfg = StreamConfig(jobs=lambda: spark.createDataFrame([(k, json.dumps(v)) for k, v in jobs.items()],
                                                          "_id string, doc string"),
                       catalog=cat, options=RunOptions(staging_root=f"{out_dir}/stage"),
                       ledger_path=f"{out_dir}/ledger", dead_letter_path=f"{out_dir}/dead",
                       clock=lambda: datetime(2024, 1, 31), stop=stop)
    batch = spark.createDataFrame([(b'{"job_doc_id": "a"}', 0, 0), (b'{"job_doc_id": "a"}', 0, 1)],
                                  "value binary, partition int, offset long")
    with pytest.raises(StopRequested):
        process_batch(spark, batch, 0, cfg)
    assert [r.offset for r in spark.read.parquet(cfg.ledger_path).collect()] == [0]
    cfg.stop = None
    process_batch(spark, batch, 0, cfg)  # the replay runs only what is left
    assert sorted(r.offset for r in spark.read.parquet(cfg.ledger_path).collect()) == [0, 1]


def test_delivery_failure_is_not_committed(spark, out_dir):
    """A failed publish fails the record: nothing is recorded as done, and the
    replay delivers once the target works."""
    from docferry.streaming.control_stream import JobFailed, process_batch

    blocked = f"{out_dir}/blocked"
    with open(blocked, "w") as fh:  # a file where the delivery folder should be
        fh.write("x")
    cat = driver_catalog(spark, SMALL)
    jobs = {"a": JOB}
    cfg = StreamConfig(jobs=lambda: spark.createDataFrame([(k, json.dumps(v)) for k, v in jobs.items()],
                                                          "_id string, doc string"),
                       catalog=cat,
                       options=RunOptions(staging_root=f"{out_dir}/stage", publish_root=blocked),
                       ledger_path=f"{out_dir}/ledger", dead_letter_path=f"{out_dir}/dead",
                       clock=lambda: datetime(2024, 1, 31))
    batch = spark.createDataFrame([(b'{"job_doc_id": "a"}', 0, 7)], "value binary, partition int, offset long")
    with pytest.raises(JobFailed):
        process_batch(spark, batch, 0, cfg)
    assert not os.path.exists(cfg.ledger_path)
    cfg.options.publish_root = f"{out_dir}/pub"
    process_batch(spark, batch, 0, cfg)
    assert [r.offset for r in spark.read.parquet(cfg.ledger_path).collect()] == [7]
    assert os.path.exists(f"{out_dir}/pub/exp/customers.csv.sha256")


def test_two_jobs_of_one_id_both_run(spark, out_dir):
    from docferry.streaming.control_stream import process_batch

    jobs = {"a": {**JOB, "job_id": "same", "remote_filename": "exp/a.csv"},
            "b": {**JOB, "job_id": "same", "remote_filename": "exp/b.csv"}}
    cfg = StreamConfig(jobs=lambda: spark.createDataFrame([(k, json.dumps(v)) for k, v in jobs.items()],
                                                          "_id string, doc string"),
                       catalog=driver_catalog(spark, SMALL),
                       options=RunOptions(staging_root=f"{out_dir}/stage", publish_root=f"{out_dir}/pub"),
                       ledger_path=f"{out_dir}/ledger", dead_letter_path=f"{out_dir}/dead",
                       clock=lambda: datetime(2024, 1, 31), strict_order=False)
    batch = spark.createDataFrame([(b'{"id": "a"}', 0, 0), (b'{"id": "b"}', 0, 1), (b'{"id": "a"}', 0, 2)],
                                  "value binary, partition int, offset long")
    process_batch(spark, batch, 0, cfg)
    assert os.path.exists(f"{out_dir}/pub/exp/a.csv.sha256") and os.path.exists(f"{out_dir}/pub/exp/b.csv.sha256")
    assert spark.read.parquet(cfg.ledger_path).count() == 3
