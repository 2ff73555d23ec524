from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pathquality.functions.clock import FAR_FUTURE
from pathquality.functions.quality import add_score, add_timings
from pathquality.plans.stitch import (
    Window,
    drop_replays,
    fold_arrivals,
    fold_halves,
    next_window,
    pair_halves,
    stitch_window,
    tile,
)
from pathquality.settings import StitchSettings
from pathquality.sources import inventory as inv
from pathquality.sources import schemas
from pathquality.sources.wire import queue_rows

from .network import T0, at, frame, halfflows, inventory_tables, record


def sessions_of(spark, rows, hi=60.0, lo=-3600.0, written=(), live_from=FAR_FUTURE, **settings):
    flows = halfflows(spark, rows)
    done = spark.createDataFrame(list(written), "community_id string, session_start timestamp")
    made = stitch_window(
        flows, queue_rows(flows), done, inv.lookups(inventory_tables(spark)),
        Window(at(lo), at(hi)), at(hi), StitchSettings(**settings), live_from,
    )
    return [] if made is None else made.collect()


def pair(cid="a", first=0.0, gap=0.01, **over):
    return [record(cid, "c2s", first, **over), record(cid, "s2c", first + gap, **over)]


def test_a_complete_session(spark):
    (s,) = sessions_of(spark, pair())
    assert s.__fields__ == [c.split()[0] for c in schemas.SESSIONS.split(",")]
    assert (s["complete"], s["asymmetric"], s["records"]) == (True, True, 2)
    assert (s["session_start"], s["session_end"]) == (at(0), at(1.01))
    assert (s["branch_id"], s["segment"], s["region"], s["router_id"]) == (
        "BR-1", "lan", "North", "R-1")
    assert (s["device_id"], s["device_type"], s["switch_id"]) == ("ATM-1", "atm", "BR-1-SW1")
    assert (s["circuit_id"], s["circuit_role"], s["provider"], s["pop_id"]) == (
        "CKT-11", "primary", "AAA", "AAA-N")
    assert (s["server_id"], s["dc"], s["criticality"]) == ("srv-1", "dc1", "critical")
    assert (s["bytes_c2s"], s["bytes_s2c"], s["packets_c2s"]) == (1000, 1000, 50)
    # the reply is first seen 10 ms later and its packets are stamped from there
    assert s["server_rtt_ms"] == pytest.approx(30)
    assert s["client_rtt_ms"] == pytest.approx(30)
    assert s["response_ms"] == pytest.approx(110)
    assert (s["quality"], s["degraded"], s["net_degraded"]) == (100, False, False)


@pytest.mark.parametrize(
    ("gap", "matched"),
    [(0.0, True), (-0.049, True), (-0.050, True), (-0.051, False), (5.0, True), (5.001, False)],
)
def test_pairing_limits(spark, gap, matched):
    halves = fold_halves(halfflows(spark, pair(gap=gap)))
    assert pair_halves(halves, 5000, 50).first()["matched"] is matched


def test_reused_flow_ids_pair_with_their_own_reply(spark):
    rows = [*pair("a", 0), *pair("a", 2), record("a", "c2s", 30)]
    halves = fold_halves(halfflows(spark, rows))
    got = {r["first_seen"]: (r["matched"], r["s_last_seen"]) for r in pair_halves(halves, 5000, 50).collect()}
    assert got[at(0)] == (True, at(1.01)) and got[at(2)] == (True, at(3.01))
    assert got[at(30)][0] is False


def test_a_reply_alone_is_no_session(spark):
    assert sessions_of(spark, [record("a", "s2c", 0)], hi=5000) == []


def test_replays_count_once(spark):
    rows = pair()
    copies = [dict(r, ingested_at=r["ingested_at"] + timedelta(seconds=3)) for r in rows]
    (s,) = sessions_of(spark, rows + copies)
    assert (s["records"], s["bytes_c2s"]) == (2, 1000)
    kept = drop_replays(halfflows(spark, rows + copies)).agg(F.max("ingested_at")).first()[0]
    assert kept == max(r["ingested_at"] for r in rows)


@pytest.mark.parametrize(
    ("seqs", "final", "whole"),
    [([0], 0, True), ([0, 1, 2], 2, True), ([0, 2], 2, False), ([0, 1], None, False),
     ([0, 0, 1], 1, True), ([1], 1, False)],
)
def test_completeness(spark, seqs, final, whole):
    rows = [
        record("a", "c2s", 0, seq=s, final=s == final, record_id=f"{i:016d}")
        for i, s in enumerate(seqs)
    ]
    half = fold_halves(halfflows(spark, rows)).first()
    assert half["whole"] is whole and half["bytes"] == 1000 * len(seqs)


def test_one_exchange_folds_alike(spark):
    rows = [record("a", "c2s", 0, seq=i % 4, final=i % 4 == 3, record_id=f"{i % 7:016d}", bytes=i % 7)
            for i in range(7)] + [*pair("b", 3), *pair("c", 5)]
    rows += [dict(r, ingested_at=r["ingested_at"] + timedelta(seconds=9)) for r in rows[2:]]
    flows = halfflows(spark, rows)
    one, many = fold_arrivals(flows), fold_halves(drop_replays(flows))
    assert one.columns == many.columns
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    plan = fold_arrivals(flows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_unfinished_session_waits_for_the_idle_timeout(spark):
    rows = [record("a", "c2s", 0, final=False, ingested_at=at(0))]
    assert sessions_of(spark, rows, lo=-1, hi=100) == []
    assert sessions_of(spark, rows, lo=890, hi=900) == []  # exactly the timeout: not yet
    (s,) = sessions_of(spark, rows, lo=890, hi=900.001)
    assert (s["complete"], s["probe_s2c"], s["records"]) == (False, "", 1)


def test_idle_is_measured_on_arrival(spark):
    late = [record("a", "c2s", 0, final=False, ingested_at=at(5000))]
    assert sessions_of(spark, late, lo=4990, hi=5010) == []


def test_late_reply_completes_a_session_at_the_recheck(spark):
    request, reply = pair()
    reply["ingested_at"] = at(40)
    # the window that saw the request is looked at again 60 s later
    (s,) = sessions_of(spark, [request, reply], lo=64, hi=66)
    assert s["complete"]


def test_a_session_is_emitted_once(spark):
    assert sessions_of(spark, pair(), written=[("a", at(0))]) == []
    assert len(sessions_of(spark, [*pair(), *pair("a", 20)], written=[("a", at(0))])) == 1


def test_repairs_leave_live_sessions_alone(spark):
    rows = [*pair("a"), *pair("b")]
    rows[2]["ingested_at"] = at(50)
    got = sessions_of(spark, rows, live_from=at(20))
    assert [s["community_id"] for s in got] == ["a"]


def test_enrichment_fallbacks(spark):
    rows = [
        *pair("guest", 0), *pair("stranger", 10), *pair("net", 20),
    ]
    for r in rows[:2]:
        r["src_ip" if r["direction"] == "c2s" else "dst_ip"] = "10.1.128.77"
    for r in rows[2:4]:
        r["src_ip" if r["direction"] == "c2s" else "dst_ip"] = "9.9.9.9"
        r["app"], r["tunnel_id"] = "unheard", 99
    for r in rows[4:]:
        r["dst_ip" if r["direction"] == "c2s" else "src_ip"] = "8.8.8.8"
    got = {s["community_id"]: s for s in sessions_of(spark, rows)}
    g, s, n = got["guest"], got["stranger"], got["net"]
    assert (g["device_id"], g["device_type"]) == ("BR-1-GUEST-10.1.128.77", "guest")
    assert (g["segment"], g["switch_id"]) == ("guest", "")
    assert (s["branch_id"], s["device_id"], s["device_type"]) == ("", "", "unknown")
    assert (s["circuit_id"], s["criticality"], s["region"]) == ("", "unknown", "")
    assert (n["server_id"], n["dc"]) == ("", "internet")


def judged(spark, **change):
    base = dict(
        ip_proto=6, matched=True, syn_us=1_000_000, s_synack_us=1_010_000, ack_us=1_050_000,
        req_us=2_000_000, s_resp_us=2_200_000, retrans=0, s_retrans=0, packets=50, s_packets=50,
        response_good_ms=200.0, response_bad_ms=600.0, rtt_good_ms=40.0, rtt_bad_ms=80.0,
        retrans_good_pct=0.5, retrans_bad_pct=2.5,
    )
    base.update(change)
    types = {bool: "boolean", int: "bigint", float: "double"}
    ddl = ", ".join(f"{k} {types[type(v)]}" for k, v in base.items())
    return add_score(add_timings(spark.createDataFrame([tuple(base.values())], ddl)), 70).first()


@pytest.mark.parametrize(
    ("change", "quality", "net"),
    [
        ({}, 100, False),
        ({"s_resp_us": 2_400_000}, 80, False),  # response half way
        ({"s_resp_us": 9_000_000}, 60, False),  # a slow server is not the network's fault
        ({"ack_us": 1_091_000}, 60, True),
        ({"retrans": 1, "s_retrans": 2}, 80, True),
        ({"retrans": 1, "s_retrans": 0}, 95, False),
        ({"matched": False, "s_packets": 0}, 0, True),
        ({"ip_proto": 17}, 100, False),
        ({"ip_proto": 17, "matched": False, "s_packets": 0, "packets": 0}, 100, False),
        ({"ip_proto": 17, "retrans": 3}, 0, True),
        ({"req_us": 0}, 100, False),  # no response time: the rest is weighed anew
        ({"s_synack_us": 900_000, "ack_us": 930_000}, 100, False),  # out of order: no server time
    ],
)
def test_scores(spark, change, quality, net):
    row = judged(spark, **change)
    assert (row["quality"], row["net_degraded"]) == (quality, net)
    assert row["degraded"] == (quality < 70)


def test_scores_round_half_to_even(spark):
    # only loss counts for UDP: 70.5 of 100 rounds to 70
    row = judged(spark, ip_proto=17, retrans=59, packets=4000, s_packets=1000,
                 retrans_good_pct=0.0, retrans_bad_pct=4.0)
    assert 100 * (4.0 - row["retrans_share"]) / 4.0 == pytest.approx(70.5)
    assert row["quality"] == 70


def test_next_window():
    s = StitchSettings()
    assert next_window(T0, at(30), s) == Window(T0, at(20))
    assert next_window(T0, at(3600), s) == Window(T0, at(120))
    assert next_window(T0, at(5), s) is None
    assert next_window(T0, at(3600), s, at(60)).hi == at(60) - timedelta(microseconds=1)
    assert next_window(T0, at(3600), s, T0) is None


def test_tiles_have_no_gaps():
    tiles = tile(T0, at(250), 120)
    assert [(w.hi - w.lo).total_seconds() for w in tiles] == [120, 120, 10]
    assert all(a.hi == b.lo for a, b in zip(tiles, tiles[1:], strict=False))
    assert tile(T0, at(-10), 120) == [] and tile(T0, T0, 120) == []


def test_hot_flow_id(spark):
    """One id carrying a third of everything is paired by time like any other."""
    rows = []
    for i in range(60):
        rows += pair("hot" if i % 3 == 0 else f"c{i}", first=i * 8.0)
    got = sessions_of(spark, rows, hi=2000)
    assert len(got) == 60 and all(s["complete"] for s in got)


def test_nothing_touched(spark):
    assert sessions_of(spark, pair(), lo=5000, hi=5100) == []


def test_naive_clock_only():
    assert StitchSettings().live_reach_s == 1020
    assert T0 == datetime(2026, 3, 2, 10)


def test_frame_helper_matches_schema(spark):
    assert frame(spark, schemas.QUEUE, []).columns == ["ingested_at", "community_id", "first_seen"]
