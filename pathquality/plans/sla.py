"""Provider SLA evidence, charged to each branch's primary circuit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sketches as sk
from ..functions.clock import between, complete
from ..functions.numeric import percent, round_even, sum_if
from ..operators.lookup import lookup
from .localise import bad_minute
from .measures import Measures

MIN_SESSIONS = 5


def switch_health(element_1m: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Per branch and minute: how many of its switches are failing and how many healthy."""
    per_switch = (
        element_1m.filter(
            (F.col("element_type") == "switch") & between(F.col("minute"), start, end)
        )
        .groupBy("element_id", "minute")
        .agg(F.sum("sessions").alias("s"), F.sum("degraded").alias("d"))
    )
    healthy = (F.col("s") >= 3) & (F.col("d") <= F.lit(0.05) * F.col("s"))
    return per_switch.groupBy(
        F.split_part("element_id", F.lit("-SW"), F.lit(1)).alias("branch_id"), "minute"
    ).agg(
        F.count_if(bad_minute(F.col("d"), F.col("s"))).alias("bad_switches"),
        F.count_if(healthy).alias("healthy_switches"),
    )


def branch_minutes(
    quality: DataFrame,
    element_1m: DataFrame,
    branches: DataFrame,
    start: datetime,
    end: datetime,
    now: datetime,
    with_rtt: bool = True,
) -> DataFrame:
    """One row per branch and minute.

    on_backup: traffic used the backup link. bank_side: one of the branch's switches is
    failing while another is healthy, so the loss is inside the branch. Both sides are
    aggregated before they meet.
    """
    primary = F.col("circuit_role") == "primary"
    sums = [
        sum_if(F.col(c), primary).alias(c)
        for c in ("sessions", "net_degraded", "retrans", "packets")
    ]
    if with_rtt:
        sums.append(sk.merge_quantiles(F.when(primary, F.col("client_rtt_ms"))).alias("rtt"))
    rows = quality.filter(between(F.col("minute"), start, end) & complete(F.col("minute"), now))
    per_minute = rows.groupBy("branch_id", "minute").agg(
        *sums, (sum_if(F.col("sessions"), F.col("circuit_role") == "backup") > 0).alias("on_backup")
    )
    flagged = per_minute.join(
        switch_health(element_1m, start, end), ["branch_id", "minute"], "left"
    )
    mixed = (F.coalesce("bad_switches", F.lit(0)) >= 1) & (
        F.coalesce("healthy_switches", F.lit(0)) >= 1
    )
    return lookup(
        flagged.withColumn("bank_side", mixed).drop("bad_switches", "healthy_switches"),
        branches,
        {"branch_id": "branch_id"},
        {"circuit_id": ("primary_circuit_id", ""), "provider": ("primary_provider", "")},
    )


def primary_rtt(
    measures: Measures,
    branches: DataFrame,
    keys: Sequence[str],
    start: datetime,
    end: datetime,
    now: datetime,
) -> DataFrame:
    """p95 round trip on primary circuits, by the branch's primary provider or circuit."""
    rows = measures.frame.filter(
        between(F.col("minute"), start, end)
        & complete(F.col("minute"), now)
        & (F.col("circuit_role") == "primary")
    ).select("branch_id", "client_rtt_ms")
    charged = lookup(
        rows, branches, {"branch_id": "branch_id"},
        {"circuit_id": ("primary_circuit_id", ""), "provider": ("primary_provider", "")},
    )
    return measures.quantile(charged, list(keys), "client_rtt_ms", 0.95, "rtt_p95")


def _charged_minute() -> Column:
    return (
        (F.col("sessions") >= MIN_SESSIONS)
        & ~F.col("bank_side")
        & bad_minute(F.col("net_degraded"), F.col("sessions"))
    )


def _share(part: str, whole: str, digits: int) -> Column:
    total = F.greatest(F.lit(1), F.sum(whole))
    return round_even(percent(F.sum(part), total), digits)


def _of(minutes: DataFrame, providers: Sequence[str] | None) -> DataFrame:
    return minutes if providers is None else minutes.filter(F.col("provider").isin(list(providers)))


def _add_rtt(minutes: DataFrame, keys: list[str], rtt: DataFrame | None, df: DataFrame):
    """WAN round trip p95, from the minutes' own sketches unless a frame is given."""
    if rtt is None:
        merged = sk.merge_quantiles(F.col("rtt"))
        rtt = minutes.groupBy(*keys).agg(sk.read_quantile(merged, 0.95).alias("rtt_p95"))
    side = rtt.select(*keys, round_even(F.col("rtt_p95")).alias("wan_rtt_p95_ms"))
    return df.join(side, keys, "left")


def provider_scorecard(
    minutes: DataFrame, providers: Sequence[str] | None = None, rtt: DataFrame | None = None
) -> DataFrame:
    mine = _of(minutes, providers)
    card = mine.groupBy("provider").agg(
        F.count_distinct("circuit_id").alias("circuits"),
        F.sum("sessions").alias("total_sessions"),
        _share("net_degraded", "sessions", 2).alias("net_degraded_pct"),
        F.count_if(_charged_minute()).alias("degraded_minutes"),
        F.count_if("on_backup").alias("outage_minutes"),
        _share("retrans", "packets", 3).alias("loss_pct"),
    )
    return _add_rtt(mine, ["provider"], rtt, card).orderBy("provider")


def provider_timeline(minutes: DataFrame, providers: Sequence[str] | None = None) -> DataFrame:
    """Network-degraded share per minute; bank-side trouble does not count against it."""
    charged = sum_if(F.col("net_degraded"), ~F.col("bank_side"))
    return (
        _of(minutes, providers)
        .groupBy("minute", "provider")
        .agg(percent(charged, F.greatest(F.lit(1), F.sum("sessions"))).alias("degraded_pct"))
        .orderBy("minute", "provider")
    )


def circuit_evidence(
    minutes: DataFrame,
    circuits: DataFrame,
    providers: Sequence[str] | None = None,
    rtt: DataFrame | None = None,
    top: int = 50,
) -> DataFrame:
    """Affected circuits with first and last affected minute, the worst first.

    The PoP comes from the inventory by the tunnel number in the circuit's name.
    """
    keys = ["circuit_id", "provider"]
    mine = _of(minutes, providers).withColumn("charged", _charged_minute())
    affected = F.when(F.col("charged") | F.col("on_backup"), F.col("minute"))
    found = (
        mine.groupBy(*keys)
        .agg(
            F.min("branch_id").alias("branch_id"),
            F.sum("sessions").alias("total_sessions"),
            F.count_if("charged").alias("degraded_minutes"),
            F.count_if("on_backup").alias("outage_minutes"),
            _share("net_degraded", "sessions", 2).alias("net_degraded_pct"),
            _share("retrans", "packets", 2).alias("loss_pct"),
            F.min(affected).alias("first_affected"),
            F.max(affected).alias("last_affected"),
        )
        .withColumn("affected_minutes", F.col("degraded_minutes") + F.col("outage_minutes"))
        .filter(F.col("affected_minutes") > 0)
    )
    order = [F.desc("affected_minutes"), F.asc("circuit_id"), F.asc("provider")]
    shown = found.orderBy(*order).limit(top)
    number = F.regexp_extract("circuit_id", "[0-9]+", 0).try_cast("bigint")
    placed = lookup(
        shown.withColumn("tunnel", number), circuits, {"tunnel": "tunnel_id"},
        {"pop_id": ("pop_id", "")},
    ).drop("tunnel")
    return _add_rtt(mine, keys, rtt, placed).orderBy(*order).drop("affected_minutes")
