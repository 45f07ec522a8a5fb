"""Control stream -> export jobs, with Structured Streaming.

``readStream`` of control records -> ``foreachBatch``:

1. decode every record of the micro-batch (T1) and append the rejects —
   null values, undecodable or malformed records — to a dead-letter table
   (T2, T3); they are committed past like every other record of the batch;
2. look the usable records up in the job table (J1, a join);
3. run the jobs one at a time in ``(partition, offset)`` order (T7); each
   job is itself a set of distributed Spark jobs (see ``plans.job_run``);
4. a finished job appends its manifest row to the ledger, keyed by
   ``(partition, offset)``; a replayed batch skips records the ledger holds
   (T8);
5. a failing job raises: the query stops and the batch is *not* committed,
   so a restart replays it (T5, T6). Nothing after the failed record runs.

Returning from the batch function commits it (checkpointed offsets).
``trigger(availableNow=True)`` drains what is there and stops (T9);
``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` 1 gives one record per batch.

The ordered job loop runs on the driver, over records that come to it a
partition at a time; no document data passes through it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docferry.operators.control import decode_control, split_control
from docferry.operators.jobs import JobSpec, lookup_jobs
from docferry.plans.job_run import RunOptions, append_manifest, append_manifests, run_export
from docferry.sources import fs
from docferry.sources.tables import Catalog

CONTROL_SCHEMA = "value binary, partition int, offset bigint"

_log = logging.getLogger(__name__)


class StopRequested(RuntimeError):
    """A graceful stop between two records; the batch is not committed, and
    the records already finished are skipped (ledger) when it is replayed."""


class JobFailed(RuntimeError):
    """A control record whose job could not be run; the batch is not committed."""

    def __init__(self, partition: int, offset: int, job_doc_id: str | None, reason: str) -> None:
        super().__init__(f"record p={partition} o={offset} job={job_doc_id}: {reason}")
        self.partition, self.offset, self.job_doc_id, self.reason = partition, offset, job_doc_id, reason


def file_control_source(spark: SparkSession, path: str, *, max_files_per_trigger: int = 1) -> DataFrame:
    """Control records from parquet files ``(value binary, partition, offset)``
    landing in ``path`` — directly, or in ``key=value`` sub-folders (test and
    batch-drop stand-in for a broker topic)."""
    return (spark.readStream.schema(CONTROL_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def kafka_control_source(spark: SparkSession, servers: str, topic: str, *,
                         max_offsets_per_trigger: int | None = 100) -> DataFrame:
    """Control records from a Kafka topic; new queries start at the earliest
    offset. Needs the Kafka connector on the cluster's classpath.

    ``max_offsets_per_trigger`` bounds a micro-batch (each record is one
    export job, and the batch's records are ordered on the driver); 1 gives
    strict one-record batches."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select("value", "partition", "offset")


@dataclass
class StreamConfig:
    jobs: Callable[[], DataFrame]          # current job table (_id, doc)
    catalog: Catalog
    options: RunOptions
    ledger_path: str                        # manifest rows of finished records
    dead_letter_path: str                   # rejected control records
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None)
    # True: one job after another in (partition, offset) order (T7). False:
    # the batch's jobs that read the same table share one scan.
    strict_order: bool = True
    # Records held by the driver when jobs share scans.
    records_at_once: int = 1000
    # Asked before each record; True ends the stream after the current job.
    stop: Callable[[], bool] | None = None


def _done(spark: SparkSession, ledger_path: str, min_offset: int | None) -> DataFrame | None:
    """Finished records at or after the batch's lowest offset (the filter
    reaches the ledger's parquet scan, so old entries are skipped by stats)."""
    if not fs.exists(spark, ledger_path):
        return None
    done = spark.read.parquet(ledger_path).select("partition", "offset")
    if min_offset is not None:
        done = done.where(F.col("offset") >= F.lit(min_offset))
    return done


def process_batch(spark: SparkSession, batch: DataFrame, epoch_id: int, cfg: StreamConfig) -> None:
    batch = batch.persist()
    try:
        _process(spark, batch, epoch_id, cfg)
    finally:
        batch.unpersist()


def _process(spark: SparkSession, batch: DataFrame, epoch_id: int, cfg: StreamConfig) -> None:
    decoded = decode_control(batch)
    ok, rejects = split_control(decoded)
    raw = batch.select(F.col("partition").cast("int").alias("partition"),
                       F.col("offset").cast("bigint").alias("offset"), F.col("value"))
    (rejects.join(raw, ["partition", "offset"], "left")
     .withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
     # A replayed batch has the same epoch id: overwrite just its partition.
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch_id").parquet(cfg.dead_letter_path))
    todo = lookup_jobs(ok, cfg.jobs(), prefilter=True)
    min_offset = batch.agg(F.min("offset")).first()[0]
    done = _done(spark, cfg.ledger_path, min_offset)
    if done is not None:
        todo = todo.join(done, ["partition", "offset"], "left_anti")
    # In order, a partition at a time: a trigger bounds files, not records.
    records = todo.orderBy("partition", "offset").toLocalIterator()
    if not cfg.strict_order:
        while some := list(islice(records, cfg.records_at_once)):
            _run_grouped(spark, some, cfg)
        return
    for rec in records:
        if cfg.stop is not None and cfg.stop():
            raise StopRequested(f"stop requested before p={rec['partition']} o={rec['offset']}")
        if rec["error"] is not None:
            raise JobFailed(rec["partition"], rec["offset"], rec["job_doc_id"], rec["error"])
        job = JobSpec.from_row(rec)
        try:
            outcome = run_export(spark, job, cfg.catalog, now=cfg.clock(), options=cfg.options)
        except Exception as e:
            raise JobFailed(rec["partition"], rec["offset"], rec["job_doc_id"], repr(e)) from e
        append_manifest(spark, cfg.ledger_path, outcome,
                        partition=rec["partition"], offset=rec["offset"])


def start(spark: SparkSession, source: DataFrame, cfg: StreamConfig, *, checkpoint: str,
          available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    writer = (source.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, epoch: process_batch(spark, df, epoch, cfg)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _run_grouped(spark: SparkSession, records: list, cfg: StreamConfig) -> None:
    """Relaxed order: validate every record first, then run the batch's jobs
    grouped by table (one scan per table)."""
    from docferry.plans.job_run import run_exports_one_scan

    for rec in records:
        if rec["error"] is not None:
            raise JobFailed(rec["partition"], rec["offset"], rec["job_doc_id"], rec["error"])
    now = cfg.clock()
    # Records of one job share a run where their jobs are the same; jobs of one
    # id that differ run one after another.
    rounds: list[dict[str, tuple[JobSpec, list]]] = []
    for rec in records:
        job = JobSpec.from_row(rec)
        for members in rounds:
            if job.job_id not in members:
                members[job.job_id] = (job, [rec])
                break
            if members[job.job_id][0] == job:
                members[job.job_id][1].append(rec)
                break
        else:
            rounds.append({job.job_id: (job, [rec])})
    for members in rounds:
        if cfg.stop is not None and cfg.stop():
            raise StopRequested("stop requested between groups of jobs")
        specs = [job for job, _ in members.values()]
        try:
            outcomes = run_exports_one_scan(spark, specs, cfg.catalog, now=now, options=cfg.options)
        except Exception as e:
            ids = ", ".join(sorted(members))
            rec = next(iter(members.values()))[1][0]
            raise JobFailed(rec["partition"], rec["offset"], None, f"one of the jobs {ids}: {e!r}") from e
        append_manifests(spark, cfg.ledger_path, [
            (outcomes[job_id], rec["partition"], rec["offset"])
            for job_id, (_, recs) in members.items() for rec in recs])
