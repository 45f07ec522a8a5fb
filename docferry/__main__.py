"""Run the control-stream export service.

    python -m docferry (--control DIR | --kafka-servers HOSTS --topic NAME) \
        --jobs PATH --tables DIR --staging DIR --publish DIR --state DIR \
        [--id-column TABLE=COLUMN] [--once] [--relaxed-order]

``--control`` holds parquet files of control records (value binary,
partition int, offset bigint); ``--jobs`` a parquet table ``(_id, doc)``;
``--tables`` one parquet table per ``data_index``, ``--id-column`` the column of
a table that is its documents' ``_id``. ``--state`` keeps the
stream checkpoint, the ledger of finished records and the dead letters.
With ``--once`` the stream drains what is there and stops.
"""

from __future__ import annotations

import argparse
import signal
import sys
import threading

from pyspark.sql import SparkSession

from docferry.plans.job_run import RunOptions
from docferry.session import tune
from docferry.sources.tables import folder_catalog
from docferry.streaming.control_stream import StreamConfig, file_control_source, kafka_control_source, start


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="docferry", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--control")
    source.add_argument("--topic")
    ap.add_argument("--kafka-servers")
    ap.add_argument("--id-column", action="append", default=[], metavar="TABLE=COLUMN")
    ap.add_argument("--jobs", required=True)
    ap.add_argument("--tables", required=True)
    ap.add_argument("--staging", required=True)
    ap.add_argument("--publish")
    ap.add_argument("--state", required=True)
    ap.add_argument("--rows-per-part", type=int, default=1_000_000)
    ap.add_argument("--ndjson")
    ap.add_argument("--guard-formulas", action="store_true")
    ap.add_argument("--relaxed-order", action="store_true")
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--trigger", default="10 seconds")
    args = ap.parse_args(argv)
    if args.topic and not args.kafka_servers:
        ap.error("--topic needs --kafka-servers")
    if not all(t and eq and c for t, eq, c in (x.partition("=") for x in args.id_column)):
        ap.error("--id-column takes TABLE=COLUMN")

    spark = tune(SparkSession.builder.appName("docferry").getOrCreate())
    stopping = threading.Event()
    # SIGTERM / SIGINT: finish the current job, then stop.
    for sig in (signal.SIGTERM, signal.SIGINT):
        signal.signal(sig, lambda *_: stopping.set())
    cfg = StreamConfig(
        jobs=lambda: spark.read.parquet(args.jobs),
        catalog=folder_catalog(spark, args.tables, ids=dict(x.split("=", 1) for x in args.id_column)),
        options=RunOptions(staging_root=args.staging, publish_root=args.publish,
                           rows_per_part=args.rows_per_part, ndjson_dir=args.ndjson,
                           guard_formulas=args.guard_formulas),
        ledger_path=f"{args.state}/ledger", dead_letter_path=f"{args.state}/dead_letters",
        strict_order=not args.relaxed_order, stop=stopping.is_set)
    records = (file_control_source(spark, args.control) if args.control
               else kafka_control_source(spark, args.kafka_servers, args.topic))
    query = start(spark, records, cfg,
                  checkpoint=f"{args.state}/checkpoint", available_now=args.once,
                  processing_time=None if args.once else args.trigger)
    try:
        while not query.awaitTermination(1):
            if stopping.is_set() and not query.status["isTriggerActive"]:
                query.stop()
    except Exception as e:  # a failed job stops the stream; its batch is replayed on restart
        if stopping.is_set() and "StopRequested" in str(e):
            return 0
        print(f"stopped: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
