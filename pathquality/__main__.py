"""Jobs for spark-submit: load-inventory, ingest, ingest-faults, stitch, restitch, alert, maintain."""

from __future__ import annotations

import argparse
import hashlib
import signal
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from .functions.clock import naive_utc
from .plans.rollup import merge_element, merge_quality
from .session import configure, shared_folder
from .sources import inventory
from .sources.files import join
from .sources.store import Store, batch_name
from .streaming.alerting import Alerting, live_results
from .streaming.ingest import (
    FAULT_TOPIC,
    FLOW_TOPIC,
    file_messages,
    ingest_batch,
    ingest_fault_batch,
    start_ingest,
    topic_messages,
    utc_now,
)
from .streaming.stitcher import Stitcher


# How the partial rows of a closed day become final ones. Rows stay as they are, but move
# together: ranges of the leading sort column, so that few files hold what a reader looks for.
MERGES = {
    "halfflows": lambda rows: rows.repartitionByRange("first_seen"),
    "queue": lambda rows: rows.repartitionByRange("ingested_at"),
    "sessions": lambda rows: rows.repartitionByRange("branch_id", "session_start"),
    "quality_1m": merge_quality,
    "element_1m": merge_element,
    "alerts": lambda rows: rows.coalesce(1),
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pathquality")
    parser.add_argument("--root", help="table folder; by default under spark.checkpoint.dir")
    sub = parser.add_subparsers(dest="job", required=True)
    load = sub.add_parser("load-inventory", help="publish a new inventory version from CSV")
    load.add_argument("--folder", required=True)
    load.add_argument("--seeds", help="folder of sla_targets.csv, if elsewhere")
    for job, topic, text in (("ingest", FLOW_TOPIC, "messages to half-flows until stopped"),
                             ("ingest-faults", FAULT_TOPIC, "messages to fault events until stopped")):
        ingest = sub.add_parser(job, help=text)
        source = ingest.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka bootstrap servers")
        source.add_argument("--files", help="folder of text files, one message per line")
        ingest.add_argument("--topic", default=topic)
        ingest.add_argument("--once", action="store_true", help="take what is there and stop")
    sub.add_parser("stitch", help="stitch new windows until stopped")
    again = sub.add_parser("restitch", help="fill missing sessions of a past range")
    again.add_argument("--since", type=datetime.fromisoformat, required=True)
    again.add_argument("--until", type=datetime.fromisoformat, required=True)
    alert = sub.add_parser("alert", help="evaluate the alert rules until stopped")
    alert.add_argument("--once", action="store_true", help="evaluate them now and stop")
    sub.add_parser("maintain", help="compact yesterday's tables and drop expired days")
    return parser.parse_args(argv)


def _short(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    args = _arguments(argv)
    spark = configure(spark or SparkSession.builder.appName(f"pathquality {args.job}").getOrCreate())
    root = args.root or join(shared_folder(spark), "pathquality")
    store, versions = Store(spark, root), join(root, "inventory")

    def lookups() -> inventory.Lookups:
        return inventory.lookups(inventory.current(spark, versions))

    if args.job == "load-inventory":
        tables = inventory.read_csv(spark, args.folder, args.seeds)
        return inventory.publish(spark, tables, versions, batch_name(utc_now(), "inventory"))
    if args.job in ("ingest", "ingest-faults"):
        if args.servers:
            messages, source = topic_messages(spark, args.servers, args.topic), f"topic-{args.topic}"
        else:
            messages, source = file_messages(spark, args.files), f"files-{_short(args.files)}"
        handle = ingest_batch if args.job == "ingest" else ingest_fault_batch
        checkpoint = join(root, "checkpoints", args.job, source)
        every = None if args.once else "8 seconds"
        return start_ingest(store, messages, checkpoint, every, handle).awaitTermination()
    worker = Stitcher(store, lookups)
    if args.job == "alert":
        worker = Alerting(store, live_results(store, lookups))
        if args.once:
            return worker.tick(utc_now())
    if args.job == "restitch":
        return worker.restitch(naive_utc(args.since), naive_utc(args.until), utc_now())
    if args.job == "maintain":
        now = utc_now()
        yesterday = now.date() - timedelta(days=1)
        for table, merge in MERGES.items():
            store.vacuum(table)  # of the round before, which no reader uses any more
            store.compact(table, yesterday, merge)
        return store.expire(now.date())
    stopped: list[int] = []
    for number in (signal.SIGTERM, signal.SIGINT):
        signal.signal(number, lambda n, _: stopped.append(n))
    return worker.run_forever(utc_now, lambda: bool(stopped))


if __name__ == "__main__":
    main()
