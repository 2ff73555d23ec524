"""Ad-hoc queries over sessions and their rollup."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import instant
from ..functions.numeric import ratio
from ..operators.quantile import exact_quantile


def _range(moment: str, start: datetime, end: datetime) -> Column:
    return (F.col(moment) >= instant(start)) & (F.col(moment) < instant(end))


def branch_by_app(
    sessions: DataFrame, branch_id: str, start: datetime, end: datetime, moment: str
) -> DataFrame:
    """One branch over a period: sessions, degraded and p95 response per application."""
    rows = sessions.filter((F.col("branch_id") == branch_id) & _range(moment, start, end))
    counts = rows.groupBy("app").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("degraded").alias("degraded")
    )
    p95 = exact_quantile(rows, ["app"], "response_ms", 0.95, "p95_ms")
    return counts.join(p95, "app", "left")


def degraded_share_raw(
    sessions: DataFrame, start: datetime, end: datetime, moment: str
) -> DataFrame:
    rows = sessions.filter(_range(moment, start, end))
    return rows.groupBy(F.date_trunc("minute", moment).alias("minute"), "criticality").agg(
        ratio(F.count_if("degraded"), F.count(F.lit(1))).alias("share")
    ).orderBy("minute", "criticality")


def degraded_share_rollup(rollup: DataFrame, start: datetime, end: datetime) -> DataFrame:
    rows = rollup.filter(_range("minute", start, end))
    return rows.groupBy("minute", "criticality").agg(
        ratio(F.sum("degraded"), F.sum("sessions")).alias("share")
    ).orderBy("minute", "criticality")


def quality_by_app(sessions: DataFrame) -> DataFrame:
    """Full scan of the columns a quality query touches."""
    return sessions.groupBy("app").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.avg("client_rtt_ms").alias("avg_rtt_ms"),
        F.count_if("degraded").alias("degraded"),
    )


def circuit_by_hour(
    sessions: DataFrame, circuit_id: str, start: datetime, end: datetime, moment: str
) -> DataFrame:
    rows = sessions.filter((F.col("circuit_id") == circuit_id) & _range(moment, start, end))
    return rows.groupBy(F.date_trunc("hour", moment).alias("hour")).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("degraded").alias("degraded")
    ).orderBy("hour")


def count_by_id(sessions: DataFrame, column: str, value) -> DataFrame:
    return sessions.filter(F.col(column) == value).agg(F.count(F.lit(1)).alias("sessions"))
