"""Dashboard queries over the rollups. Every one stops at the last complete minute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import between, complete, floor_minute, instant, last_minutes, millis_between
from ..functions.numeric import percent, ratio, round_even, sum_if
from ..operators.keyed import heaviest_item, latest_per_key
from .measures import Measures

P95 = 0.95


@dataclass(frozen=True)
class Scope:
    """A dashboard's selection. None selects everything. The provider is the branch's
    primary one from the inventory, so a failed-over branch stays where it belongs."""

    branches: DataFrame
    regions: Sequence[str] | None = None
    providers: Sequence[str] | None = None

    def of(self, rows: DataFrame) -> DataFrame:
        if self.regions is not None:
            rows = rows.filter(F.col("region").isin(list(self.regions)))
        if self.providers is not None:
            mine = self.branches.filter(F.col("primary_provider").isin(list(self.providers)))
            rows = rows.join(mine.select("branch_id"), "branch_id", "left_semi")
        return rows


def _minute() -> Column:
    return F.col("minute")


# --- estate tiles -------------------------------------------------------------------


def reachability(
    quality: DataFrame, circuits: DataFrame, scope: Scope, now: datetime, minutes: int = 5
) -> DataFrame:
    """Share of the expected branches with any traffic lately."""
    expected = circuits.filter(F.col("role") == "primary")
    if scope.providers is not None:
        expected = expected.filter(F.col("provider").isin(list(scope.providers)))
    if scope.regions is not None:
        regional = scope.branches.filter(F.col("region").isin(list(scope.regions)))
        expected = expected.join(regional.select("branch_id"), "branch_id", "left_semi")
    seen = quality.filter(last_minutes(_minute(), now, minutes)).join(
        expected.select("branch_id"), "branch_id", "left_semi"
    )
    wanted = expected.agg(F.count(F.lit(1))).scalar()
    return seen.agg(F.count_distinct("branch_id").alias("n")).select(
        percent(F.col("n"), wanted).alias("reachable_pct")
    )


def estate_quality(quality: DataFrame, scope: Scope, now: datetime, minutes: int = 5) -> DataFrame:
    """Mean session score and share of degraded sessions."""
    rows = scope.of(quality.filter(last_minutes(_minute(), now, minutes)))
    return rows.agg(
        ratio(F.sum("quality_sum"), F.sum("sessions")).alias("score"),
        percent(F.sum("degraded"), F.sum("sessions")).alias("degraded_pct"),
    )


def branches_degraded_now(
    quality: DataFrame,
    scope: Scope,
    now: datetime,
    minutes: int = 5,
    min_sessions: int = 10,
    share: float = 0.2,
) -> DataFrame:
    rows = scope.of(quality.filter(last_minutes(_minute(), now, minutes)))
    per_branch = rows.groupBy("branch_id").agg(
        F.sum("sessions").alias("s"), F.sum("degraded").alias("d")
    )
    bad = per_branch.filter(
        (F.col("s") >= min_sessions) & (ratio(F.col("d"), F.col("s")) >= share)
    )
    return bad.agg(F.count(F.lit(1)).alias("branches"))


def devices_affected(
    measures: Measures, scope: Scope, now: datetime, minutes: int = 5
) -> DataFrame:
    rows = scope.of(measures.frame.filter(last_minutes(_minute(), now, minutes)))
    return measures.devices(rows, []).select(
        percent(F.col("degraded_devices"), F.col("devices")).alias("devices_pct")
    )


def app_p95(
    measures: Measures, scope: Scope, app: str, now: datetime, minutes: int = 5
) -> DataFrame:
    """95th percentile response time of one application."""
    rows = scope.of(measures.frame.filter(last_minutes(_minute(), now, minutes)))
    return measures.quantile(rows.filter(F.col("app") == app), [], "response_ms", P95, "p95_ms")


# --- estate series ------------------------------------------------------------------


def degraded_by_minute(
    quality: DataFrame, scope: Scope, start: datetime, end: datetime, now: datetime
) -> DataFrame:
    """Degraded share per minute and criticality."""
    rows = quality.filter(between(_minute(), start, end) & complete(_minute(), now))
    return (
        scope.of(rows)
        .groupBy("minute", "criticality")
        .agg(percent(F.sum("degraded"), F.sum("sessions")).alias("degraded_pct"))
        .orderBy("minute", "criticality")
    )


def degraded_total_by_minute(quality: DataFrame, start: datetime, end: datetime) -> DataFrame:
    rows = quality.filter(between(_minute(), start, end))
    return rows.groupBy("minute").agg(F.sum("degraded").alias("degraded")).orderBy("minute")


def p95_by_app_minute(
    measures: Measures,
    scope: Scope,
    start: datetime,
    end: datetime,
    now: datetime,
    criticality: str = "critical",
) -> DataFrame:
    rows = scope.of(
        measures.frame.filter(
            between(_minute(), start, end)
            & complete(_minute(), now)
            & (F.col("criticality") == criticality)
        )
    )
    series = measures.quantile(rows, ["minute", "app"], "response_ms", P95, "p95_ms")
    return series.orderBy("minute", "app")


# --- branches -----------------------------------------------------------------------


def branch_ranking(
    quality: DataFrame,
    measures: Measures,
    scope: Scope,
    start: datetime,
    end: datetime,
    now: datetime,
    card_app: str = "card_authorisation",
    backup_minutes: int = 3,
    min_sessions: int = 10,
    top: int = 15,
) -> DataFrame:
    """Worst branches first; one running on its backup circuit always surfaces.

    The counts decide who is shown; everything costlier is computed for those rows only.
    """
    in_range = between(_minute(), start, end) & complete(_minute(), now)
    rows = scope.of(quality.filter(in_range))
    primary = F.col("circuit_role") == "primary"
    recent = F.col("minute") >= instant(floor_minute(now) - timedelta(minutes=backup_minutes))
    backup_now = sum_if(F.col("sessions"), (F.col("circuit_role") == "backup") & recent) > 0
    shown = (
        rows.groupBy("branch_id")
        .agg(
            F.min("region").alias("region"),
            F.coalesce(F.min(F.when(primary, F.col("provider"))), F.lit("")).alias("provider"),
            F.when(backup_now, "backup").otherwise("primary").alias("circuit"),
            F.sum("sessions").alias("sessions"),
            round_even(percent(F.sum("degraded"), F.sum("sessions")), 1).alias("degraded_pct"),
            round_even(ratio(F.sum("quality_sum"), F.sum("sessions")), 1).alias("mean_score"),
        )
        .filter(F.col("sessions") >= min_sessions)
    )
    order = [
        (F.col("circuit") == "backup").desc(),
        F.desc("degraded_pct"),
        F.desc("sessions"),
        F.asc("branch_id"),
    ]
    shown = shown.orderBy(*order).limit(top)
    only = F.broadcast(shown.select("branch_id"))  # at most `top` rows
    mine = rows.join(only, "branch_id")

    per_minute = mine.groupBy("branch_id", "minute").agg(
        F.sum("sessions").alias("s"), F.sum("degraded").alias("d")
    )
    crossed = (F.col("d") >= F.lit(0.2) * F.col("s")) & (F.col("s") >= 3)
    since = per_minute.groupBy("branch_id").agg(
        F.min(F.when(crossed, F.col("minute"))).alias("degraded_since")
    )
    worst_app = heaviest_item(mine, ["branch_id"], "app", "degraded", "top_app")

    source = scope.of(measures.frame.filter(in_range)).join(only, "branch_id")
    card = measures.quantile(
        source.filter(F.col("app") == card_app), ["branch_id"], "response_ms", P95, "p95"
    ).select("branch_id", round_even(F.col("p95")).alias("card_p95_ms"))
    devices = measures.devices(source, ["branch_id"]).select(
        "branch_id", F.col("degraded_devices").alias("devices_hit")
    )
    result = shown
    for part in (worst_app, card, devices, since):
        result = result.join(part, "branch_id", "left")
    return result.orderBy(*order)


def worst_branches_timeline(
    quality: DataFrame,
    scope: Scope,
    start: datetime,
    end: datetime,
    now: datetime,
    top: int = 10,
    min_sessions: int = 10,
) -> DataFrame:
    """Mean score per minute of the worst branches, labelled by rank."""
    rows = quality.filter(between(_minute(), start, end) & complete(_minute(), now))
    worst = (
        scope.of(rows)
        .groupBy("branch_id")
        .agg(F.sum("sessions").alias("s"), F.sum("degraded").alias("d"))
        .filter(F.col("s") >= min_sessions)
        .select("branch_id", ratio(F.col("d"), F.col("s")).alias("share"))
        .orderBy(F.desc("share"), "branch_id")
        .limit(top)
    )
    position = F.row_number().over(W.orderBy(F.desc("share"), "branch_id"))  # `top` rows
    labels = worst.select(
        "branch_id",
        F.concat(F.lpad(position.cast("string"), 2, "0"), F.lit(" · "), "branch_id").alias("branch"),
    )
    return (
        rows.join(F.broadcast(labels), "branch_id")
        .groupBy("minute", "branch")
        .agg(round_even(ratio(F.sum("quality_sum"), F.sum("sessions"))).alias("quality"))
        .orderBy("minute", "branch")
    )


def filter_options(rows: DataFrame, column: str, since: datetime | None = None) -> DataFrame:
    """The values a dashboard filter offers."""
    if since is not None:
        rows = rows.filter(F.col("minute") > instant(since))
    return rows.select(column).distinct().orderBy(column)


# --- pipeline -----------------------------------------------------------------------


def ingest_rate(queue: DataFrame, now: datetime, seconds: int = 60) -> DataFrame:
    recent = queue.filter(F.col("ingested_at") >= instant(now - timedelta(seconds=seconds)))
    return recent.agg((F.count(F.lit(1)) / seconds).alias("rows_per_s"))


def ingest_rate_series(
    arrivals: DataFrame, start: datetime, end: datetime, now: datetime, part: str = "partition"
) -> DataFrame:
    """Records per second in 10 s buckets by source partition; only full buckets."""
    width = 10
    bucket = F.timestamp_seconds(F.floor(F.unix_seconds("ingested_at") / width) * width)
    current = F.timestamp_seconds(F.floor(F.unix_seconds(instant(now)) / width) * width)
    rows = arrivals.filter(
        between(F.col("ingested_at"), start, end) & (F.col("ingested_at") < current)
    )
    return (
        rows.groupBy(bucket.alias("time"), part)
        .agg((F.count(F.lit(1)) / width).alias("rows_per_s"))
        .orderBy("time", part)
    )


def freshness_p95(
    sessions: DataFrame, start: datetime, end: datetime, quantile
) -> DataFrame:
    """p95 seconds from a session's end to its arrival in the store, per minute."""
    rows = sessions.filter(
        between(F.col("stitched_at"), start, end)
        & (F.col("session_start") >= instant(start - timedelta(days=1)))
    ).select(
        F.date_trunc("minute", "stitched_at").alias("time"),
        millis_between(F.col("session_end"), F.col("stitched_at")).alias("ms"),
    )
    late = quantile(rows, ["time"], "ms", P95, "p95_ms")
    return late.select("time", (F.col("p95_ms") / 1000).alias("seconds")).orderBy("time")


def stitch_lag(
    watermarks: DataFrame, now: datetime, expected: int = 1, job: str = "stitch",
    missing: int | None = None,
) -> DataFrame:
    """Seconds the oldest shard is behind; `missing` until all expected shards reported."""
    latest = latest_per_key(
        watermarks.filter(F.col("job") == job).select("shard", "watermark", "updated_at"),
        ["shard"],
        ["updated_at"],
    )
    behind = F.unix_seconds(instant(now)) - F.unix_seconds(F.min("watermark"))
    return latest.agg(
        F.when(F.count(F.lit(1)) < expected, F.lit(missing).cast("bigint"))
        .otherwise(behind)
        .alias("lag_s")
    )


def errors_since(errors: DataFrame, now: datetime, span: timedelta = timedelta(days=1)) -> DataFrame:
    recent = errors.filter(F.col("received_at") >= instant(now - span))
    return recent.agg(F.count(F.lit(1)).alias("errors"))


def sessions_stitched(sessions: DataFrame, now: datetime, hours: int = 1) -> DataFrame:
    """Sessions written lately; the start bound lets old days be skipped."""
    recent = (F.col("stitched_at") >= instant(now - timedelta(hours=hours))) & (
        F.col("session_start") >= instant(now - timedelta(hours=hours + 24))
    )
    return sessions.filter(recent).agg(F.count(F.lit(1)).alias("sessions"))
