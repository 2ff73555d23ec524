"""Fault events to incidents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import EPOCH, instant
from ..operators.keyed import latest_per_key

ATTRIBUTES = ("kind", "target", "target_type", "label", "source")


def incidents(events: DataFrame, now: datetime) -> DataFrame:
    """One row per fault that has started.

    An end from before the latest start belongs to an earlier run and is ignored; a fault
    whose end never arrives closes at its planned end.
    """
    unique = latest_per_key(events, ["fault_id", "state"], ["event_at"])
    begun, over = F.col("state") == "started", F.col("state") == "ended"
    facts = F.struct(*ATTRIBUTES, "event_at", "end_at")
    folded = unique.groupBy("fault_id").agg(
        F.max_by(facts, F.when(begun, F.col("event_at"))).alias("start"),
        F.coalesce(F.max(F.when(over, F.col("event_at"))), instant(EPOCH)).alias("ended_event"),
        F.bool_or(begun).alias("has_start"),
    )
    closed = F.col("ended_event") >= F.col("start.event_at")
    return folded.filter("has_start").select(
        "fault_id",
        *[F.col(f"start.{c}").alias(c) for c in ATTRIBUTES],
        F.col("start.event_at").alias("started_at"),
        F.when(closed, F.col("ended_event"))
        .otherwise(F.least(F.col("start.end_at"), instant(now)))
        .alias("ended_at"),
        (~closed & (F.col("start.end_at") > instant(now))).alias("ongoing"),
    )


def overlapping(found: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Incidents visible in [start, end]."""
    return found.filter(
        (F.col("started_at") <= instant(end))
        & (F.col("ongoing") | (F.col("ended_at") >= instant(start)))
    )


def annotations(found: DataFrame, start: datetime, end: datetime, now: datetime) -> DataFrame:
    return overlapping(found, start, end).select(
        F.col("started_at").alias("time"),
        F.when(F.col("ongoing"), instant(now)).otherwise(F.col("ended_at")).alias("time_end"),
        F.col("label").alias("text"),
        F.col("kind").alias("tags"),
    )


def recent(found: DataFrame, since: datetime, top: int = 20) -> DataFrame:
    """The latest incidents; an ongoing one has no end yet."""
    return (
        found.filter(F.col("started_at") >= instant(since))
        .select(
            "started_at",
            F.when(~F.col("ongoing"), F.col("ended_at")).alias("ended_at"),
            "kind", "target", "label", "source", "fault_id",
        )
        .orderBy(F.desc("started_at"), "fault_id")
        .limit(top)
    )
