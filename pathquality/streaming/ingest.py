"""Continuous ingest: a topic of messages becomes half-flows, queue rows and refusals.

A batch is named after its arrival time, its stream, by the id its checkpoint holds, and its
number, so a stream with a new checkpoint never replaces what an earlier one wrote, and names
sort as batches arrived. It is journalled with its
arrival time before anything is written and again when all is written. A replayed batch keeps
its first arrival time, and stitching never passes the arrival time of a batch that is still
being written: however long that takes, its rows are visible when their window is read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..sources import wire
from ..settings import StitchSettings
from ..sources.files import join
from ..sources.store import INGEST, Planned, Store, batch_name

# The topics of flows and of fault events.
FLOW_TOPIC = "netflow.halfflows.v1"
FAULT_TOPIC = "netflow.faults.v1"
Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def topic_messages(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = 10_000_000
) -> DataFrame:
    """Messages from a Kafka topic (needs Spark's Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select("value", "topic", "partition", "offset")
    )


def file_messages(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Messages from text files, one per line; the file name stands in for the topic."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    return lines.select("value", F.col("_metadata.file_name").alias("topic"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream a checkpoint belongs to; Spark writes it before the first batch."""
    lines = spark.read.text(join(checkpoint, "metadata")).collect()
    return json.loads("".join(r["value"] for r in lines))["id"]


def _begin(store: Store, stream: str, batch_id: int, clock: Clock) -> Planned:
    """Journal a batch. A batch that began before keeps its name and arrival time; a new one is
    only stamped by a journal entry that was written well before stitching could pass the
    stamp."""
    job, own = f"{INGEST}{stream}", f"{stream}-{batch_id:015d}"
    known = store.newest(job)
    if known is not None and known.batch_id.endswith(f"-{own}"):
        return known
    patience = timedelta(seconds=StitchSettings().safety_s / 2)
    while True:
        stamp = clock()
        plan = Planned(batch_name(stamp, own), stamp, stamp, stamp)
        store.note(job, 0, plan, "planned", stamp)
        if clock() - stamp <= patience:
            return plan


def _write(store: Store, stream: str, batch_id: int, clock: Clock, tables, fill) -> None:
    plan = _begin(store, stream, batch_id, clock)
    for table in tables:
        store.discard(table, plan.batch_id)
    fill(plan.batch_id, plan.lo)
    store.note(f"{INGEST}{stream}", 0, plan, "done", plan.lo)


def ingest_batch(
    store: Store, messages: DataFrame, batch_id: int, clock: Clock, stream: str = "flows"
) -> None:
    """Write one batch. Repeating a batch replaces what the first try left."""

    def fill(name: str, now: datetime) -> None:
        parsed = wire.parse_halfflows(messages, now).persist()
        try:
            good = wire.accepted_halfflows(parsed, now)
            store.write("halfflows", good, name)
            store.write("ingest_errors", wire.refused(parsed, wire.HALFFLOW_KEY_FIELDS, now), name)
            # last: a queued id must find its records
            store.write("queue", wire.queue_rows(good), name)
        finally:
            parsed.unpersist()

    _write(store, stream, batch_id, clock, ("halfflows", "queue", "ingest_errors"), fill)


def ingest_fault_batch(
    store: Store, messages: DataFrame, batch_id: int, clock: Clock, stream: str = "faults"
) -> None:
    def fill(name: str, now: datetime) -> None:
        parsed = wire.parse_faults(messages).persist()
        try:
            store.write("fault_events", wire.accepted_faults(parsed), name)
            store.write("ingest_errors", wire.refused(parsed, wire.FAULT_KEY_FIELDS, now), name)
        finally:
            parsed.unpersist()

    _write(store, stream, batch_id, clock, ("fault_events", "ingest_errors"), fill)


def start_ingest(
    store: Store,
    messages: DataFrame,
    checkpoint: str,
    every: str | None = "8 seconds",
    handle=ingest_batch,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """`every=None` takes what is there and stops. The arrival time of a batch is read once
    on the driver, so every row of it agrees. Every source and topic needs a checkpoint of its
    own."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        handle(store, rows, batch_id, clock, stream_id(store.spark, checkpoint))

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()
