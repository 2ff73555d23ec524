"""Rollups, localisation, incidents, SLA evidence and alerts on small literal data."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pathquality.functions import sketches as sk
from pathquality.plans import alerts, panels, sla
from pathquality.plans.incidents import annotations, incidents, overlapping, recent
from pathquality.plans.localise import (
    best_by_period,
    hit_rate,
    localise,
    most_likely,
    rank_elements,
    with_exact_details,
)
from pathquality.plans.measures import Exact, Sketched
from pathquality.plans.panels import Scope
from pathquality.plans.rollup import element_1m, merge_element, merge_quality, quality_1m
from pathquality.operators.path import explode_path
from pathquality.sources import schemas

from .network import at, frame

NOW = datetime(2026, 3, 2, 10, 10, 30)
MINUTE = datetime(2026, 3, 2, 10, 9)


def session(n, minute=MINUTE, degraded=False, **over):
    base = dict(
        session_start=minute + timedelta(seconds=n % 60), session_end=minute, community_id=f"s{n}",
        stitched_at=minute, complete=True, asymmetric=False, records=2, probe_c2s="GW-1",
        probe_s2c="GW-1", app="pay", criticality="critical", branch_id="BR-1", region="North",
        router_id="R-1", switch_id="BR-1-SW1", device_id=f"D{n}", device_type="atm",
        circuit_id="CKT-1", circuit_role="primary", provider="AAA", pop_id="P", server_id="srv",
        bytes_c2s=1, bytes_s2c=1, packets_c2s=10, packets_s2c=10, retrans_c2s=0, retrans_s2c=0,
        response_ms=100.0 + n, client_rtt_ms=20.0, quality=20 if degraded else 100,
        degraded=degraded, net_degraded=degraded,
    )
    base.update(over)
    return base


def sessions(spark, rows):
    return frame(spark, schemas.SESSIONS, rows)


def branches(spark, *rows):
    made = rows or [("BR-1", "North", "AAA", "CKT-1"), ("BR-2", "South", "BBB", "CKT-2")]
    return spark.createDataFrame(
        made, "branch_id string, region string, primary_provider string, primary_circuit_id string"
    )


def two_branches():
    """BR-1's router path is broken, BR-2's is fine; both use the same server and app."""
    rows = [session(i, degraded=i < 8) for i in range(10)]
    rows += [
        session(100 + i, branch_id="BR-2", region="South", router_id="R-2", switch_id="BR-2-SW1",
                circuit_id="CKT-2", provider="BBB", pop_id="Q", probe_s2c="GW-2")
        for i in range(10)
    ]
    return rows


def test_partial_rollups_merge_to_the_whole(spark):
    rows = two_branches()
    whole_q, whole_e = quality_1m(sessions(spark, rows)), element_1m(sessions(spark, rows))
    parts = [sessions(spark, rows[i::3]) for i in range(3)]
    q = merge_quality(quality_1m(parts[0]).unionByName(quality_1m(parts[1])).unionByName(quality_1m(parts[2])))
    e = merge_element(element_1m(parts[0]).unionByName(element_1m(parts[1])).unionByName(element_1m(parts[2])))

    def quality(df):
        return {tuple(r) for r in df.select(
            "minute", "branch_id", "sessions", "degraded", "quality_sum",
            sk.read_distinct(F.col("devices")), sk.read_distinct(F.col("degraded_devices")),
            sk.read_quantile(F.col("response_ms"), 0.95)).collect()}

    def element(df):
        return {(r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in df.select(
            "element_type", "element_id", "sessions", "degraded", "degraded_apps",
            sk.read_distinct(F.col("degraded_branches"))).collect()}

    assert quality(q) == quality(whole_q) and element(e) == element(whole_e)
    assert ("router", "R-1", 10, 8, ("pay",), 1) in element(e)
    assert ("router", "R-2", 10, 0, (), 0) in element(e)
    gateways = {r[1]: r[2] for r in element(e) if r[0] == "gateway"}
    assert gateways == {"GW-1": 20, "GW-2": 10}  # equal gateways count once


def test_sketch_errors_are_bounded(spark):
    rows = spark.range(40_000).select(
        F.lit("a").alias("k"), F.concat(F.lit("d"), F.col("id") % 9_000).alias("d"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("double").alias("x"))
    got = rows.groupBy("k").agg(
        sk.read_distinct(sk.distinct_state(F.col("d"))).alias("n"),
        sk.read_quantile(sk.quantile_state(F.col("x")), 0.95).alias("q")).first()
    assert got["n"] == pytest.approx(9_000, rel=0.05)
    rank = rows.filter(F.col("x") <= got["q"]).count() / 40_000
    assert rank == pytest.approx(0.95, abs=0.02)


def test_empty_sketch_reads_as_null(spark):
    df = sessions(spark, [session(1, response_ms=None)])
    row = quality_1m(df).select(sk.read_quantile(F.col("response_ms"), 0.5).alias("q")).first()
    assert row["q"] is None


def test_localise_finds_the_tied_elements(spark):
    rolled = element_1m(sessions(spark, two_branches()))
    got = localise(rolled, NOW, 5, 5).collect()
    assert {(r["element_type"], r["element_id"]) for r in got[:4]} == {
        ("circuit", "CKT-1"), ("pop", "P"), ("provider", "AAA"), ("router", "R-1")}
    top = got[0]
    assert (top["precision"], top["coverage"], top["score"]) == (0.8, 1.0, 0.889)
    assert (top["devices_hit"], top["branches_hit"], top["apps_hit"]) == (8, 1, ["pay"])
    assert top["since"] == MINUTE
    facts = most_likely(localise(rolled, NOW, 5, 5)).first()
    assert facts["cause"] == "circuit · CKT-1" and facts["coverage_pct"] == 100.0


def test_localise_details_agree_between_sketches_and_sessions(spark):
    df = sessions(spark, two_branches())
    ranked = rank_elements(element_1m(df), 5, 10)
    paths = explode_path(df, ["device_id", "branch_id", "app", "degraded"])
    exact = [tuple(r) for r in with_exact_details(ranked, paths).select(
        "element_type", "element_id", "score", "devices_hit", "branches_hit").collect()]
    sketched = [tuple(r) for r in localise(element_1m(df), NOW, 5, 5).select(
        "element_type", "element_id", "score", "devices_hit", "branches_hit").collect()]
    assert exact == sketched


def test_localise_windows_and_thresholds(spark):
    rows = two_branches()
    assert localise(element_1m(sessions(spark, rows)), NOW, 5, 9).collect() == []
    current = [session(i, NOW.replace(second=0), degraded=True) for i in range(9)]
    assert localise(element_1m(sessions(spark, current)), NOW, 5, 5).collect() == []
    healthy = [session(i) for i in range(9)]
    got = localise(element_1m(sessions(spark, healthy)), NOW, 5, 0).collect()
    assert got and all(r["score"] is None for r in got)  # nothing degraded: no ratio
    stray = [session(0, MINUTE - timedelta(minutes=3), degraded=True)]
    stray += [session(i, MINUTE - timedelta(minutes=3)) for i in range(1, 30)]
    got = localise(element_1m(sessions(spark, rows + stray)), NOW, 5, 5).filter(
        "element_id = 'R-1'").first()
    assert got["since"] == MINUTE  # a single degraded session is not a start


def event(fid, state, t, end=None, **over):
    base = dict(fault_id=fid, state=state, event_at=at(t), kind="down", target="circuit:CKT-1",
                target_type="circuit", label=f"{fid}@{t}", source="s", start_at=at(t),
                end_at=at(end if end is not None else t), latency_ms=0.0, loss=0.0,
                server_factor=1.0)
    base.update(over)
    return base


def test_incidents(spark):
    rows = [
        event("closed", "started", 0, 500), event("closed", "ended", 100),
        event("open", "started", 0, 5000), event("lost", "started", 0, 50),
        event("rerun", "started", 300, 400), event("rerun", "ended", 200),
        event("orphan", "ended", 10),
        event("twice", "started", 0, 10), event("twice", "started", 60, 90),
        event("twice", "ended", 80), event("twice", "ended", 80),
    ]
    found = incidents(frame(spark, schemas.FAULT_EVENTS, rows), at(1000))
    got = {r["fault_id"]: (r["started_at"], r["ended_at"], r["ongoing"]) for r in found.collect()}
    assert got == {
        "closed": (at(0), at(100), False), "open": (at(0), at(1000), True),
        "lost": (at(0), at(50), False), "rerun": (at(300), at(400), False),
        "twice": (at(60), at(80), False),
    }
    seen = {r["fault_id"] for r in overlapping(found, at(100), at(299)).collect()}
    assert seen == {"closed", "open"}
    assert annotations(found, at(0), at(1), at(1000)).filter("time_end = time").count() == 0
    assert recent(found, at(50)).select("fault_id").collect()[0][0] == "rerun"


def test_hit_rate_counts_ties(spark):
    rolled = element_1m(sessions(spark, two_branches()))
    best = best_by_period(rolled, 600, 5)
    assert {r["element_id"] for r in best.collect()} == {"CKT-1", "P", "AAA", "R-1", "BR-1-SW1"}
    started = [("f1", "router", "R-1", MINUTE, MINUTE), ("f2", "router", "R-2", MINUTE, MINUTE),
               ("f3", "router", "R-1", MINUTE - timedelta(days=1), MINUTE - timedelta(days=1))]
    rows = spark.createDataFrame(
        started, "fault_id string, target_type string, target_id string, started_at timestamp, "
                 "ended_at timestamp")
    got = hit_rate(rows, best, 600).first()
    assert tuple(got) == (3, 1, 0.3333)


def sla_rows(spark, rows):
    df = sessions(spark, rows)
    inv = branches(spark)
    start, end = MINUTE - timedelta(hours=1), NOW
    return sla.branch_minutes(quality_1m(df), element_1m(df), inv, start, end, NOW)


def test_provider_is_charged_for_its_circuit(spark):
    rows = two_branches()
    card = {r["provider"]: r for r in sla.provider_scorecard(sla_rows(spark, rows)).collect()}
    assert (card["AAA"]["degraded_minutes"], card["AAA"]["net_degraded_pct"]) == (1, 80.0)
    assert (card["BBB"]["degraded_minutes"], card["BBB"]["outage_minutes"]) == (0, 0)
    assert card["AAA"]["wan_rtt_p95_ms"] == 20.0 and card["AAA"]["circuits"] == 1


@pytest.mark.parametrize(
    ("change", "bank_side", "charged"),
    [
        ({}, False, 1),  # one switch only: cannot tell
        ({"healthy": 5}, True, 0),  # another switch is fine: the loss is inside
        ({"healthy": 2}, False, 1),  # too few sessions to call it healthy
        ({"count": 4}, False, 0),  # too few sessions in the minute
        ({"net": False}, False, 0),  # slow server: not the network
    ],
)
def test_bank_side_minutes_are_not_charged(spark, change, bank_side, charged):
    net = change.get("net", True)
    rows = [session(i, degraded=True, net_degraded=net) for i in range(change.get("count", 6))]
    rows += [session(50 + i, switch_id="BR-1-SW2") for i in range(change.get("healthy", 0))]
    minutes = sla_rows(spark, rows)
    row = minutes.first()
    assert row["bank_side"] is bank_side
    assert sla.provider_scorecard(minutes).first()["degraded_minutes"] == charged
    rate = sla.provider_timeline(minutes).first()["degraded_pct"]
    assert (rate == 0.0) == (bank_side or not net)


def test_backup_traffic_is_an_outage_of_the_primary(spark):
    rows = [session(i, circuit_id="CKT-9", circuit_role="backup", provider="BBB") for i in range(6)]
    minutes = sla_rows(spark, rows)
    card = sla.provider_scorecard(minutes).first()
    assert (card["provider"], card["outage_minutes"], card["total_sessions"]) == ("AAA", 1, 0)
    assert card["wan_rtt_p95_ms"] is None
    circuits = spark.createDataFrame([(1, "P")], "tunnel_id bigint, pop_id string")
    ev = sla.circuit_evidence(minutes, circuits).first()
    assert (ev["circuit_id"], ev["pop_id"], ev["first_affected"]) == ("CKT-1", "P", MINUTE)
    healthy = sla_rows(spark, [session(i) for i in range(6)])
    assert sla.circuit_evidence(healthy, circuits).collect() == []


def test_panels_agree_between_sketches_and_sessions(spark):
    rows = sessions(spark, two_branches()).withColumn("minute", F.date_trunc("minute", "session_start"))
    rolled, scope = quality_1m(rows), Scope(branches(spark))
    args = (scope, MINUTE - timedelta(hours=1), NOW, NOW)
    exact = panels.branch_ranking(rolled, Exact(rows), *args, card_app="pay").collect()
    sketched = panels.branch_ranking(rolled, Sketched(rolled), *args, card_app="pay").collect()
    assert [r["branch_id"] for r in exact] == ["BR-1", "BR-2"]
    first = exact[0]
    assert (first["degraded_pct"], first["mean_score"], first["top_app"], first["devices_hit"],
            first["degraded_since"], first["circuit"]) == (80.0, 36.0, "pay", 8, MINUTE, "primary")
    assert [r["devices_hit"] for r in exact] == [r["devices_hit"] for r in sketched]
    assert exact[1]["top_app"] == "" and exact[1]["degraded_since"] is None
    south = Scope(branches(spark), regions=["South"], providers=["BBB"])
    assert panels.estate_quality(rolled, south, NOW).first()["score"] == 100.0
    circuits = spark.createDataFrame(
        [("BR-1", "AAA", "primary"), ("BR-2", "BBB", "primary"), ("BR-3", "BBB", "primary"),
         ("BR-1", "BBB", "backup")], "branch_id string, provider string, role string")
    assert panels.reachability(rolled, circuits, scope, NOW).first()[0] == pytest.approx(200 / 3)
    line = panels.worst_branches_timeline(rolled, *args).collect()
    assert [r["branch"] for r in line] == ["01 · BR-1", "02 · BR-2"]
    assert panels.branches_degraded_now(rolled, scope, NOW).first()[0] == 1
    assert panels.devices_affected(Exact(rows), scope, NOW).first()[0] == 40.0


def test_branch_alert_masks_shared_causes(spark):
    inv = branches(spark)

    def pct(rows):
        rolled = quality_1m(sessions(spark, rows))
        return {r["branch_id"]: r["net_degraded_pct"] for r in alerts.branch_degraded(rolled, inv, NOW).collect()}

    alone = [session(i, degraded=i < 4) for i in range(10)]
    alone += [session(100 + i, branch_id="BR-2") for i in range(90)]
    assert pct(alone) == {"BR-1": 40.0, "BR-2": 0.0}
    shared = [session(i, degraded=i < 4) for i in range(10)]
    shared += [session(100 + i, branch_id="BR-2", degraded=i < 4) for i in range(10)]
    assert pct(shared) == {"BR-1": 0.0, "BR-2": 0.0}


def test_other_alerts(spark):
    rows = [session(i, circuit_role="backup") for i in range(3)]
    rolled = quality_1m(sessions(spark, rows))
    assert [tuple(r) for r in alerts.on_backup(rolled, branches(spark), NOW).collect()] == [
        ("BR-1", "North", 3)]
    assert alerts.card_slow(Sketched(rolled), NOW, "pay").first()["p95_ms"] == 102.0
    marks = spark.createDataFrame(
        [("stitch", 0, at(0), at(1)), ("stitch", 0, at(60), at(61)), ("other", 1, at(0), at(9))],
        "job string, shard int, watermark timestamp, updated_at timestamp")
    assert alerts.lagging(marks, at(100), 1).first()[0] == 40
    assert alerts.lagging(marks, at(100), 2).first()[0] == 86_400
    assert panels.stitch_lag(marks, at(100), 2).first()[0] is None
    queue = spark.createDataFrame([(at(0),)], "ingested_at timestamp")
    stopped = alerts.RULES["ingest_stopped"]
    for now, breach in ((at(60), False), (at(300), True)):
        assert alerts.breaches(alerts.ingest_stopped(queue, now), stopped).first()["breach"] is breach
    errors = spark.createDataFrame([(at(0),)], "received_at timestamp")
    assert alerts.ingest_errors(errors, at(600)).first()[0] == 1
    assert alerts.ingest_errors(errors, at(601)).first()[0] == 0


def test_alert_holds_before_firing(spark):
    # evaluated every minute; the breach must hold two minutes; minute 9 has no row for "b"
    history = [("a", at(60 * i), i not in (0, 4)) for i in range(12)]
    history += [("b", at(60 * i), True) for i in range(12) if i != 9]
    df = spark.createDataFrame(history, "label string, evaluated_at timestamp, breach boolean")
    got = {(r["label"], r["evaluated_at"]): r["state"] for r in
           alerts.alert_states(df, ["label"], 120, 60).collect()}
    a = [got["a", at(60 * i)][0] for i in range(12)]
    assert "".join(a) == "nppfnppfffff"
    b = [got["b", at(60 * i)][0] for i in range(12) if i != 9]
    assert "".join(b) == "ppfffffffpp"


def test_every_rule_has_one_threshold():
    for rule in alerts.RULES.values():
        assert (rule.above is None) != (rule.below is None)
