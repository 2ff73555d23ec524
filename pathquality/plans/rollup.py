"""Per-minute rollups with mergeable states.

A batch contributes partial rows; every reader groups again, so it does not matter how the
partials happen to be split or compacted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sketches as sk
from ..operators.keyed import bounded_distinct
from ..operators.path import PATH_COLUMNS, explode_path

QUALITY_KEYS = (
    "minute", "branch_id", "region", "provider", "pop_id", "circuit_id", "circuit_role", "app",
    "criticality",
)
QUALITY_SUMS = (
    "sessions", "degraded", "net_degraded", "bytes", "packets", "retrans", "quality_sum",
)
ELEMENT_KEYS = ("minute", "element_type", "element_id")
APPS, MAX_APPS = "degraded_apps", 16


def minute_of(moment: Column | str) -> Column:
    return F.date_trunc("minute", moment)


def _on(condition: Column | str, value: Column | str) -> Column:
    return F.when(F.col(condition) if isinstance(condition, str) else condition, value)


def quality_1m(sessions: DataFrame, keys: Sequence[str] = QUALITY_KEYS) -> DataFrame:
    """Service quality by where traffic came from and what it was. Fewer keys give the same
    rollup merged: far fewer rows for a reader that never asks for the others."""
    timed = sessions.withColumn("minute", minute_of("session_start"))
    return timed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("degraded").alias("degraded"),
        F.count_if("net_degraded").alias("net_degraded"),
        F.sum(F.col("bytes_c2s") + F.col("bytes_s2c")).alias("bytes"),
        F.sum(F.col("packets_c2s") + F.col("packets_s2c")).alias("packets"),
        F.sum(F.col("retrans_c2s") + F.col("retrans_s2c")).alias("retrans"),
        F.sum("quality").cast("bigint").alias("quality_sum"),
        sk.quantile_state(F.col("response_ms")).alias("response_ms"),
        sk.quantile_state(F.col("client_rtt_ms")).alias("client_rtt_ms"),
        sk.distinct_state(F.col("device_id")).alias("devices"),
        sk.distinct_state(_on("degraded", F.col("device_id"))).alias("degraded_devices"),
    )


def merge_quality(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*QUALITY_KEYS).agg(
        *[F.sum(c).alias(c) for c in QUALITY_SUMS],
        sk.merge_quantiles(F.col("response_ms")).alias("response_ms"),
        sk.merge_quantiles(F.col("client_rtt_ms")).alias("client_rtt_ms"),
        sk.merge_distinct(F.col("devices")).alias("devices"),
        sk.merge_distinct(F.col("degraded_devices")).alias("degraded_devices"),
    )


def element_1m(
    sessions: DataFrame, path=PATH_COLUMNS, moment: str = "session_start",
    only: DataFrame | None = None,
) -> DataFrame:
    """The same sessions seen from every element on their path, or from a few (`only`, to be
    broadcast).

    The bounded list of degraded applications is ranked from the degraded sessions alone,
    on the same keys, so it meets the counts without another shuffle.
    """
    keep = [
        minute_of(moment).alias("minute"),
        F.col("app").alias("via_app"),
        "branch_id",
        "device_id",
        "degraded",
        F.col("response_ms").alias("response"),
    ]

    def crossed(rows: DataFrame, columns: list) -> DataFrame:
        steps = explode_path(rows, columns, path)
        if only is None:
            return steps
        wanted = only.select("element_type", "element_id")
        return steps.join(F.broadcast(wanted), ["element_type", "element_id"], "left_semi")

    counted = crossed(sessions, keep).groupBy(*ELEMENT_KEYS).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("degraded").alias("degraded"),
        sk.quantile_state(F.col("response")).alias("response_ms"),
        sk.distinct_state(F.col("device_id")).alias("devices"),
        sk.distinct_state(_on("degraded", F.col("device_id"))).alias("degraded_devices"),
        sk.distinct_state(_on("degraded", F.col("branch_id"))).alias("degraded_branches"),
    )
    hit = crossed(sessions.filter("degraded"), keep[:2])
    return _with_apps(counted, bounded_distinct(hit, ELEMENT_KEYS, "via_app", MAX_APPS, APPS))


def merge_element(partials: DataFrame) -> DataFrame:
    merged = partials.groupBy(*ELEMENT_KEYS).agg(
        F.sum("sessions").alias("sessions"),
        F.sum("degraded").alias("degraded"),
        sk.merge_quantiles(F.col("response_ms")).alias("response_ms"),
        sk.merge_distinct(F.col("devices")).alias("devices"),
        sk.merge_distinct(F.col("degraded_devices")).alias("degraded_devices"),
        sk.merge_distinct(F.col("degraded_branches")).alias("degraded_branches"),
    )
    names = partials.select(*ELEMENT_KEYS, F.explode(APPS).alias("name"))
    return _with_apps(merged, bounded_distinct(names, ELEMENT_KEYS, "name", MAX_APPS, APPS))


def _with_apps(counted: DataFrame, lists: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return counted.join(lists, list(ELEMENT_KEYS), "left").withColumn(
        APPS, F.coalesce(APPS, none)
    )
