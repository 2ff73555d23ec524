"""Which single element best explains the degraded sessions?"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sketches as sk
from ..functions.clock import last_minutes
from ..functions.numeric import ratio, round_even
from .rollup import MAX_APPS

ELEMENT = ("element_type", "element_id")
FACTS = ("degraded", "sessions", "precision", "coverage", "score", "since")


def bad_minute(degraded: Column, sessions: Column) -> Column:
    """Meaningfully degraded, not a stray session."""
    return degraded >= F.greatest(F.lit(2.0), F.lit(0.2) * sessions)


def _order() -> list[Column]:
    return [F.desc_nulls_last("score"), F.desc_nulls_last("precision"), *map(F.asc, ELEMENT)]


def _score(df: DataFrame, all_degraded: Column) -> DataFrame:
    p, c = F.col("precision"), F.col("coverage")
    return (
        df.withColumn("precision", round_even(ratio(F.col("degraded"), F.col("sessions")), 3))
        .withColumn("coverage", round_even(ratio(F.col("degraded"), all_degraded), 3))
        .withColumn("score", round_even(F.try_divide(F.lit(2.0) * p * c, p + c), 3))
    )


def rank_elements(rows: DataFrame, min_degraded: int, top: int) -> DataFrame:
    """Rank by the harmonic mean of precision and coverage. Reads only the counts.

    Coverage is measured against the degraded sessions of `app` elements: every session
    has exactly one application, so none is counted twice.
    """
    per_minute = rows.groupBy(*ELEMENT, "minute").agg(
        F.sum("sessions").alias("sessions"), F.sum("degraded").alias("degraded")
    )
    bad = bad_minute(F.col("degraded"), F.col("sessions"))
    per_element = per_minute.groupBy(*ELEMENT).agg(
        F.sum("sessions").alias("sessions"),
        F.sum("degraded").alias("degraded"),
        F.min(F.when(bad, F.col("minute"))).alias("since"),
    )
    total = rows.filter(F.col("element_type") == "app").agg(F.sum("degraded")).scalar()
    scored = _score(per_element.filter(F.col("degraded") >= min_degraded), total)
    return scored.orderBy(*_order()).limit(top).select(*ELEMENT, *FACTS)


def _first_names(named: DataFrame, keys: tuple[str, ...], aggregates: list[Column]) -> DataFrame:
    """Per ranked element: the aggregates, and up to MAX_APPS names from `name`."""
    per_element = W.partitionBy(*ELEMENT).orderBy(F.asc_nulls_last("name"))
    short = F.when(F.row_number().over(per_element) <= MAX_APPS, F.col("name"))
    return (
        named.withColumn("name", short)
        .groupBy(*keys)
        .agg(*aggregates, F.array_sort(F.collect_set("name")).alias("apps_hit"))
    )


def with_sketch_details(ranked: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct devices and branches from the sketches, for the ranked elements only.

    Repeating a sketch for each application name does not change its union.
    """
    keys = (*ELEMENT, *FACTS)
    states = ("degraded_devices", "degraded_branches")
    hit = rows.select(*ELEMENT, *states, "degraded_apps").join(F.broadcast(ranked), list(ELEMENT))
    named = (
        hit.select(*keys, *states, F.explode_outer("degraded_apps").alias("name"))
        .groupBy(*keys, "name")
        .agg(*[sk.merge_distinct(F.col(s)).alias(s) for s in states])
    )
    merged = [
        sk.read_distinct(sk.merge_distinct(F.col("degraded_devices"))).alias("devices_hit"),
        sk.read_distinct(sk.merge_distinct(F.col("degraded_branches"))).alias("branches_hit"),
    ]
    return _first_names(named, keys, merged).orderBy(*_order())


def with_exact_details(ranked: DataFrame, paths: DataFrame) -> DataFrame:
    """The same facts counted exactly from exploded sessions (element, device_id, branch_id,
    app, degraded)."""
    keys = (*ELEMENT, *FACTS)
    hit = (
        paths.filter("degraded")
        .select(*ELEMENT, "device_id", "branch_id", F.col("app").alias("name"))
        .join(F.broadcast(ranked), list(ELEMENT))
        .distinct()
    )
    counts = hit.groupBy(*ELEMENT).agg(
        F.count_distinct("device_id").alias("devices_hit"),
        F.count_distinct("branch_id").alias("branches_hit"),
    )
    names = _first_names(hit.select(*keys, "name").distinct(), keys, [F.count(F.lit(1)).alias("n")])
    return names.drop("n").join(counts, list(ELEMENT)).orderBy(*_order())


def localise(
    element_1m: DataFrame, now: datetime, window_min: int = 5, min_degraded: int = 5, top: int = 10
) -> DataFrame:
    rows = element_1m.filter(last_minutes(F.col("minute"), now, window_min))
    return with_sketch_details(rank_elements(rows, min_degraded, top), rows)


def most_likely(candidates: DataFrame) -> DataFrame:
    """The top candidate as headline facts."""
    return candidates.orderBy(*_order()).limit(1).select(
        F.concat_ws(" · ", *ELEMENT).alias("cause"),
        (F.lit(100) * F.col("coverage")).alias("coverage_pct"),
        (F.lit(100) * F.col("precision")).alias("precision_pct"),
        "devices_hit",
        F.unix_millis("since").alias("since_ms"),
    )


def best_by_period(rows: DataFrame, period_s: int, min_degraded: int) -> DataFrame:
    """Localisation of every period at once: the elements sharing the top score."""
    period = F.floor(F.unix_seconds("minute") / period_s).alias("period")
    per_element = (
        rows.select(period, *ELEMENT, "sessions", "degraded")
        .groupBy("period", *ELEMENT)
        .agg(F.sum("sessions").alias("sessions"), F.sum("degraded").alias("degraded"))
    )
    totals = (
        per_element.filter(F.col("element_type") == "app")
        .groupBy("period")
        .agg(F.sum("degraded").alias("all_degraded"))
    )
    scored = _score(
        per_element.filter(F.col("degraded") >= min_degraded).join(totals, "period"),
        F.col("all_degraded"),
    )
    best = scored.groupBy("period").agg(F.max("score").alias("score"))
    return scored.join(best, ["period", "score"]).select("period", *ELEMENT, "score")


def hit_rate(incidents: DataFrame, best: DataFrame, period_s: int) -> DataFrame:
    """How many incidents had their target among the best candidates of a period they
    overlap. Incidents are spread over their periods, so the match is an equality."""
    spread = incidents.select(
        "fault_id",
        F.col("target_type").alias("element_type"),
        F.col("target_id").alias("element_id"),
        F.explode(
            F.sequence(
                F.floor(F.unix_seconds("started_at") / period_s),
                F.floor(F.unix_seconds("ended_at") / period_s),
            )
        ).alias("period"),
    )
    found = spread.join(best, ["period", *ELEMENT], "left_semi").select("fault_id").distinct()
    flagged = incidents.select("fault_id").join(
        found.withColumn("hit", F.lit(True)), "fault_id", "left"
    )
    return flagged.agg(
        F.count(F.lit(1)).alias("incidents"),
        F.count_if("hit").alias("hits"),
        round_even(ratio(F.count_if("hit"), F.count(F.lit(1))), 4).alias("hit_rate"),
    )
