"""Alert rules: each yields label columns and exactly one numeric column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import instant, last_minutes
from ..functions.numeric import percent, round_even
from ..operators.lookup import lookup
from .measures import Measures
from .panels import stitch_lag


@dataclass(frozen=True)
class Rule:
    """When a rule's value breaches, and for how long before it fires. `no_data` says what
    an empty result means."""

    name: str
    value: str
    above: float | None = None
    below: float | None = None
    hold_s: int = 0
    severity: str = "warning"
    no_data: str = "ok"


# Thresholds and holding times.
RULES = {
    r.name: r
    for r in (
        Rule("branch_degraded", "net_degraded_pct", above=0, hold_s=120, severity="critical"),
        Rule("fault_localised", "score", above=0, hold_s=120, severity="critical"),
        Rule("card_slow", "p95_ms", above=900, hold_s=180, severity="critical"),
        Rule("on_backup", "sessions", above=0, hold_s=60),
        Rule("stitch_lag", "lag_s", above=120, hold_s=180),
        Rule("ingest_errors", "errors", above=0),
        Rule("ingest_stopped", "records", below=1, hold_s=120, severity="critical",
             no_data="alerting"),
    )
}


def branch_degraded(
    quality: DataFrame, branches: DataFrame, now: datetime, minutes: int = 3,
    min_sessions: int = 10, factor: float = 3.0,
) -> DataFrame:
    """A branch's own network failing: at least 20 % and `factor` times the estate's rate, so
    a shared cause does not raise one alert per branch. Labels come from the inventory, so a
    failover does not change an alert's identity."""
    rows = quality.filter(last_minutes(F.col("minute"), now, minutes))
    estate = rows.agg(percent(F.sum("net_degraded"), F.sum("sessions"))).scalar()
    per_branch = (
        rows.groupBy("branch_id")
        .agg(F.sum("net_degraded").alias("n"), F.sum("sessions").alias("s"))
        .filter(F.col("s") >= min_sessions)
        .select("branch_id", round_even(percent(F.col("n"), F.col("s")), 1).alias("pct"))
    )
    judged = per_branch.withColumn(
        "net_degraded_pct",
        F.when(F.col("pct") >= F.greatest(F.lit(20.0), F.lit(factor) * estate), F.col("pct"))
        .otherwise(0.0),
    )
    return lookup(
        judged, branches, {"branch_id": "branch_id"},
        {"region": ("region", ""), "provider": ("primary_provider", "")},
    ).select("branch_id", "region", "provider", "net_degraded_pct")


def fault_localised(ranked: DataFrame, min_score: float = 0.5) -> DataFrame:
    """`ranked`: the localisation's top candidates (5 minutes, 20 degraded, top 3)."""
    return ranked.filter(F.col("score") >= min_score).select("element_type", "element_id", "score")


def card_slow(
    measures: Measures, now: datetime, app: str = "card_authorisation", minutes: int = 3
) -> DataFrame:
    rows = measures.frame.filter(
        last_minutes(F.col("minute"), now, minutes) & (F.col("app") == app)
    )
    return measures.quantile(rows, [], "response_ms", 0.95, "p95_ms")


def on_backup(
    quality: DataFrame, branches: DataFrame, now: datetime, minutes: int = 2
) -> DataFrame:
    rows = quality.filter(
        last_minutes(F.col("minute"), now, minutes) & (F.col("circuit_role") == "backup")
    )
    used = rows.groupBy("branch_id").agg(F.sum("sessions").alias("sessions"))
    return lookup(
        used, branches, {"branch_id": "branch_id"}, {"region": ("region", "")}
    ).select("branch_id", "region", "sessions")


def lagging(watermarks: DataFrame, now: datetime, expected: int = 1) -> DataFrame:
    """A shard that has never reported counts as a day behind."""
    return stitch_lag(watermarks, now, expected, missing=86_400)


def ingest_errors(errors: DataFrame, now: datetime, minutes: int = 10) -> DataFrame:
    recent = errors.filter(F.col("received_at") >= instant(now - timedelta(minutes=minutes)))
    return recent.agg(F.count(F.lit(1)).alias("errors"))


def ingest_stopped(queue: DataFrame, now: datetime, minutes: int = 2) -> DataFrame:
    recent = queue.filter(F.col("ingested_at") >= instant(now - timedelta(minutes=minutes)))
    return recent.agg(F.count(F.lit(1)).alias("records"))


def breaches(result: DataFrame, rule: Rule) -> DataFrame:
    """The rule's result with a boolean `breach` column."""
    value = F.col(rule.value)
    over = value > rule.above if rule.above is not None else value < rule.below
    return result.withColumn("breach", F.coalesce(over, F.lit(rule.no_data == "alerting")))


def evaluations(results: dict[str, DataFrame], rules: dict[str, Rule] = RULES) -> DataFrame:
    """All results as one table: rule, labels (JSON), severity, hold_s, value, breach. Of rows
    that share their labels the worst counts."""

    def rows(rule: Rule) -> DataFrame:
        found = breaches(results[rule.name], rule)
        labels = [c for c in results[rule.name].columns if c != rule.value]
        value = F.col(rule.value).cast("double").alias("value")
        return found.select(
            F.lit(rule.name).alias("rule"),
            (F.to_json(F.struct(*labels)) if labels else F.lit("{}")).alias("labels"),
            F.lit(rule.severity).alias("severity"), F.lit(rule.hold_s).alias("hold_s"),
            value if rule.above is not None else (-value).alias("value"), "breach")

    every = reduce(DataFrame.unionByName, [rows(rules[name]) for name in results])
    below = [name for name in results if rules[name].below is not None]
    worst = F.max("value")
    return every.groupBy("rule", "labels", "severity", "hold_s").agg(
        F.when(F.col("rule").isin(below), -worst).otherwise(worst).alias("value"),
        F.bool_or("breach").alias("breach"))


def advance(current: DataFrame, before: DataFrame, at: datetime, gap_s: int) -> DataFrame:
    """One tick: rule, labels, severity, value, state, previous, since, evaluated_at of every
    label set that is not normal at `at`, or was not at the tick before.

    `current`: rows as `evaluations` gives; `before`: what the last tick left that was not
    normal. A breach goes on from where it stands unless the last tick is more than `gap_s`
    ago; a label set no longer evaluated is normal.
    """
    now = instant(at)
    old = before.select(
        "rule", "labels", F.col("severity").alias("_severity"), F.col("state").alias("_state"),
        F.col("since").alias("_since"), F.col("evaluated_at").alias("_at"))
    breach = F.coalesce("breach", F.lit(False))
    carried = F.unix_seconds(now) - F.unix_seconds("_at") <= gap_s
    since = F.when(breach, F.when(carried, F.col("_since")).otherwise(now))
    held = F.unix_seconds(now) - F.unix_seconds("since")
    state = F.when(F.col("since").isNull(), "normal").when(
        held >= F.col("hold_s"), "firing").otherwise("pending")
    met = current.join(old, ["rule", "labels"], "full_outer").withColumn("since", since)
    return met.select(
        "rule", "labels", F.coalesce("severity", "_severity").alias("severity"), "value",
        state.alias("state"), F.coalesce("_state", F.lit("normal")).alias("previous"), "since",
        now.alias("evaluated_at"),
    ).filter("state <> 'normal' or previous <> 'normal'")


def alert_states(
    history: DataFrame, labels: Sequence[str], hold_s: int, interval_s: int
) -> DataFrame:
    """The state of every evaluation: normal, pending, or firing once the breach has held
    for `hold_s`. A label set absent from an evaluation is back to normal.

    `history`: labels, evaluated_at, breach. Only the last `hold_s` matter to a state, so
    time is cut into blocks that each also see the block before: a label set with a long
    history is not one task's work.
    """
    width = hold_s + interval_s
    at = F.unix_seconds("evaluated_at")
    block = F.floor(at / width)
    seen = (
        history.withColumn("_at", at)
        .withColumn("_own", block)
        .withColumn("_block", F.explode(F.array(block, block + 1)))
    )
    order = W.partitionBy(*labels, "_block").orderBy("_at")
    before = F.lag("_at").over(order)
    broke = F.lag("breach").over(order)
    opens = F.col("breach") & (
        before.isNull() | (F.col("_at") - before > interval_s) | ~F.coalesce(broke, F.lit(False))
    )
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = seen.withColumn("_opened", F.when(opens, F.col("_at"))).withColumn(
        "_since", F.last("_opened", ignorenulls=True).over(running)
    )
    held = F.col("_at") - F.col("_since")
    state = (
        F.when(~F.col("breach"), "normal").when(held >= hold_s, "firing").otherwise("pending")
    )
    return (
        marked.filter(F.col("_own") == F.col("_block"))
        .withColumn("state", state)
        .drop("_at", "_own", "_block", "_opened", "_since")
    )
