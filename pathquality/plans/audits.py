"""Checks that nothing was lost, doubled or left without inventory data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import between
from ..functions.numeric import ratio


def lost_sessions(
    halfflows: DataFrame, sessions: DataFrame, arrived_from: datetime, arrived_to: datetime
) -> DataFrame:
    """Finished client halves, chosen by arrival time, that have no session."""
    finished = halfflows.filter(
        (F.col("direction") == "c2s")
        & F.col("is_final")
        & between(F.col("ingested_at"), arrived_from, arrived_to)
    ).select("community_id", "first_seen")
    known = sessions.select("community_id", F.col("session_start").alias("first_seen"))
    missing = finished.distinct().join(known, ["community_id", "first_seen"], "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("lost"))


def session_integrity(sessions: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Duplicates, share of incomplete sessions, sessions the inventory could not place."""
    rows = sessions.filter(between(F.col("session_start"), start, end))
    bare = (
        (F.col("branch_id") == "") | (F.col("circuit_id") == "")
        | (F.col("device_type") == "unknown")
    )
    per_key = rows.groupBy("community_id", "session_start").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("complete")).alias("incomplete"),
        F.count_if(bare).alias("bare"),
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        ratio(F.sum("incomplete"), F.sum("n")).alias("incomplete_share"),
        F.coalesce(F.sum("bare"), F.lit(0)).alias("unenriched"),
    )
