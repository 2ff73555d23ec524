from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pathquality.functions.network import community_id, ipv4_number, network_of
from pathquality.sources import wire

from .network import T0, us

GOOD = {
    "record_id": "0123456789abcdef", "community_id": "m", "direction": "c2s",
    "first_seen_us": us(0), "exported_at_us": us(1), "probe_id": "p", "src_ip": "10.16.0.20",
    "dst_ip": "10.200.1.10",
}
WEEK, HOUR = 7 * 86_400, 3_600
CASES = [
    ({}, None),
    ({"record_id": "short"}, "invalid record_id"),
    ({"record_id": "0123456789abcdef-too-long"}, "invalid record_id"),
    ({"record_id": "é" * 8}, None),  # sixteen bytes
    ({"direction": "sideways"}, "invalid direction"),
    ({"community_id": ""}, "missing community_id"),
    ({"first_seen_us": 1}, "first_seen_us outside the accepted window"),
    ({"first_seen_us": us(-WEEK)}, None),
    ({"first_seen_us": us(-WEEK) - 1}, "first_seen_us outside the accepted window"),
    ({"first_seen_us": us(HOUR)}, None),
    ({"first_seen_us": us(HOUR) + 1}, "first_seen_us outside the accepted window"),
    ({"record_id": "short", "direction": "sideways"}, "invalid record_id"),
    ({"record_seq": "many"}, "unparsable message"),
    ({"src_ip": "10.16.0.999"}, "unparsable message"),
    ({"tcp_syn_us": None, "unknown": [1, 2]}, None),
]


def parse(spark, values):
    rows = [(v, "flows", 3, i) for i, v in enumerate(values)]
    messages = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")
    return wire.parse_halfflows(messages, T0)


def test_each_message_is_accepted_or_refused_with_its_first_reason(spark):
    values = [json.dumps({**GOOD, **change}) for change, _ in CASES] + ["{not json", ""]
    parsed = parse(spark, values)
    got = {r["offset"]: r["error"] for r in parsed.collect()}
    want = [reason for _, reason in CASES] + ["unparsable message"] * 2
    assert [got[i] for i in range(len(values))] == want
    good = wire.accepted_halfflows(parsed, T0)
    bad = wire.refused(parsed, wire.HALFFLOW_KEY_FIELDS, T0)
    assert good.count() + bad.count() == len(values)


def test_refusals_keep_the_payload(spark):
    bad = wire.refused(
        parse(spark, ["{not json", json.dumps({**GOOD, "direction": "x"})]),
        wire.HALFFLOW_KEY_FIELDS, T0,
    )
    rows = {r["kafka_offset"]: r for r in bad.collect()}
    assert rows[0]["raw_message"] == "{not json"
    assert json.loads(rows[1]["raw_message"]) == {
        "record_id": GOOD["record_id"], "community_id": "m", "direction": "x",
        "first_seen_us": str(us(0)),
    }
    assert (rows[1]["topic"], rows[1]["partition"]) == ("flows", 3)


def test_absent_fields_become_defaults(spark):
    row = wire.accepted_halfflows(parse(spark, [json.dumps(GOOD)]), T0).first()
    assert row["bytes"] == 0 and row["app"] == "" and row["is_final"] is False
    assert row["tcp_syn"].timestamp() == 0 or row["tcp_syn"].year == 1970
    assert row["first_seen"] == T0 and row["ingested_at"] == T0


def test_fault_messages(spark):
    values = [
        {"fault_id": "f1", "state": "started", "event_at_us": us(0)},
        {"fault_id": "", "state": "started"},
        {"fault_id": "f2", "state": "paused"},
    ]
    messages = spark.createDataFrame([(json.dumps(v),) for v in values], "value string")
    parsed = wire.parse_faults(messages)
    assert [r["error"] for r in parsed.collect()] == [None, "missing fault_id", "invalid state"]
    assert wire.accepted_faults(parsed).count() == 1
    refused = wire.refused(parsed, wire.FAULT_KEY_FIELDS, T0 + timedelta(hours=1))
    assert refused.filter(F.col("topic").isNull()).count() == 2


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"kind": "explode"}, "kind must be degrade, down or slow"),
        ({"target_type": "moon"}, "unknown target type"),
        ({"kind": "down", "target_type": "router"}, "down needs a circuit"),
        ({"kind": "slow", "target_type": "router"}, "slow needs a server or app"),
        ({"kind": "degrade", "target_type": "server"}, "degrade needs a network element"),
        ({"latency_ms": float("inf")}, "numbers must be finite"),
        ({"loss": float("nan")}, "numbers must be finite"),
        ({"latency_ms": 10_001.0}, "latency_ms out of range"),
        ({"loss": 0.5}, "loss out of range"),
        ({"server_factor": 0.5}, "server_factor out of range"),
    ],
)
def test_fault_rules(spark, change, reason):
    base = {"kind": "degrade", "target_type": "circuit", "latency_ms": 10.0, "loss": 0.1,
            "server_factor": 1.0}
    row = {**base, **change}
    ddl = "kind string, target_type string, latency_ms double, loss double, server_factor double"
    df = spark.createDataFrame([tuple(row.values())], ddl)
    assert df.select(wire.fault_rule_error().alias("e")).first()["e"] == reason


def test_fault_target_must_exist(spark):
    ddl = "kind string, target_type string, latency_ms double, loss double, server_factor double"
    df = spark.createDataFrame([("degrade", "circuit", 1.0, 0.1, 1.0)], ddl)
    assert df.select(wire.fault_rule_error(F.lit(False))).first()[0] == "unknown target"


def test_community_id(spark):
    ddl = "s string, d string, sp int, dp int, p int"
    rows = [("128.232.110.120", "66.35.250.204", 34855, 80, 6),
            ("66.35.250.204", "128.232.110.120", 80, 34855, 6)]
    got = spark.createDataFrame(rows, ddl).select(community_id(*map(F.col, "s d sp dp p".split())))
    # the published example of the format
    assert [r[0] for r in got.collect()] == ["1:LQU9qZlK+B5F3KDmev6m5PMibrg="] * 2


def test_addresses(spark):
    rows = [("0.0.0.0",), ("255.255.255.255",), ("10.1.2.3",), ("1.2.3",), ("1.2.3.256",), ("",),
            (None,), ("a.b.c.d",)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string").select(ipv4_number(F.col("a"))).collect()]
    assert got == [0, 2**32 - 1, (10 << 24) + (1 << 16) + (2 << 8) + 3] + [None] * 5
    nets = spark.range(1).select(
        *[network_of(F.lit((10 << 24) + 777), n).alias(f"n{n}") for n in (0, 8, 24, 32)]
    ).first()
    assert list(nets) == [0, 10 << 24, (10 << 24) + 768, (10 << 24) + 777]
