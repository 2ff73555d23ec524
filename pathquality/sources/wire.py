"""Messages to typed rows, with a reason for every message that is refused.

A frame of messages has the columns of a topic source: value, topic, partition, offset.
Accepting is defined as "no reason to refuse", so the two outputs always add up.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import instant, micros_of
from ..functions.network import ipv4_number
from ..settings import ACCEPT_FUTURE_S, ACCEPT_PAST_S
from . import schemas

_BAD = "_bad"


def _parsed(messages: DataFrame, ddl: str) -> DataFrame:
    """Parse JSON; a message that is not JSON or has a mistyped field sets the bad column.
    Absent and null fields become 0 or ''."""
    fields = [part.split() for part in ddl.split(",")]
    row = F.from_json(
        F.col("value").cast("string"),
        f"{ddl}, {_BAD} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD},
    )
    keep = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    parsed = messages.select("value", *keep, row.alias("m"))
    values = [
        F.coalesce(
            F.col(f"m.{name}"), F.lit("" if kind == "string" else 0).cast(kind)
        ).alias(name)
        for name, kind in fields
    ]
    broken = F.col(f"m.{_BAD}").isNotNull() | F.col("m").isNull()
    return parsed.select("value", *keep, broken.alias("unparsed"), *values)


def parse_halfflows(messages: DataFrame, now: datetime) -> DataFrame:
    """Wire columns plus `error`: NULL for an acceptable record, else the first reason."""
    now_s = micros_of(now) // 1_000_000
    in_window = F.col("first_seen_us").between(
        (now_s - ACCEPT_PAST_S) * 1_000_000, (now_s + ACCEPT_FUTURE_S) * 1_000_000
    )
    parsed = _parsed(messages, schemas.WIRE_HALFFLOW)
    bad_ip = [
        (F.col(c) != "") & ipv4_number(F.col(c)).isNull() for c in ("src_ip", "dst_ip")
    ]
    parsed = parsed.withColumn("unparsed", F.col("unparsed") | bad_ip[0] | bad_ip[1])
    return parsed.withColumn("error", halfflow_error(in_window))


def halfflow_error(in_window: Column) -> Column:
    """The ordered reasons to refuse a half-flow."""
    return (
        F.when(F.col("unparsed"), "unparsable message")
        .when(F.octet_length("record_id") != 16, "invalid record_id")
        .when(~F.col("direction").isin("c2s", "s2c"), "invalid direction")
        .when(F.col("community_id") == "", "missing community_id")
        .when(~in_window, "first_seen_us outside the accepted window")
    )


def parse_faults(messages: DataFrame) -> DataFrame:
    reason = (
        F.when(F.col("unparsed"), "unparsable message")
        .when(F.col("fault_id") == "", "missing fault_id")
        .when(~F.col("state").isin("started", "ended"), "invalid state")
    )
    return _parsed(messages, schemas.WIRE_FAULT).withColumn("error", reason)


def accepted_halfflows(parsed: DataFrame, ingested_at: datetime) -> DataFrame:
    """Accepted records in the columns of the half-flow table."""
    made = {"is_final": F.col("is_final") == 1, "ingested_at": instant(ingested_at)}
    for name in ("first_seen", "exported_at", "flow_start", "flow_end", "tcp_syn", "tcp_synack",
                 "tcp_ack", "first_req", "first_resp"):
        made[name] = F.timestamp_micros(f"{name}_us")
    for name in ("src_ip", "dst_ip"):
        made[name] = F.when(F.col(name) == "", "0.0.0.0").otherwise(F.col(name))
    columns = [c.split()[0] for c in schemas.HALFFLOWS.split(",")]
    good = parsed.filter(F.col("error").isNull())
    return good.select(*[made.get(c, F.col(c)).alias(c) for c in columns])


def queue_rows(halfflows: DataFrame) -> DataFrame:
    """What the stitcher has to look at: one row per accepted record."""
    return halfflows.select("ingested_at", "community_id", "first_seen")


def accepted_faults(parsed: DataFrame) -> DataFrame:
    good = parsed.filter(F.col("error").isNull())
    return good.select(
        "fault_id",
        "state",
        F.timestamp_micros("event_at_us").alias("event_at"),
        "kind",
        "target",
        "target_type",
        "label",
        "source",
        F.timestamp_micros("start_us").alias("start_at"),
        F.timestamp_micros("end_us").alias("end_at"),
        "latency_ms",
        "loss",
        "server_factor",
    )


def refused(parsed: DataFrame, key_fields: list[str], received_at: datetime) -> DataFrame:
    """Refused messages with reason: the raw payload if it could not be parsed, else its
    key fields as JSON."""
    pairs = [x for f in key_fields for x in (F.lit(f), F.col(f).cast("string"))]
    payload = F.when(F.col("unparsed"), F.col("value").cast("string")).otherwise(
        F.to_json(F.create_map(*pairs))
    )

    def origin(name: str, kind: str) -> Column:
        present = name in parsed.columns
        return (F.col(name) if present else F.lit(None)).cast(kind)

    return parsed.filter(F.col("error").isNotNull()).select(
        instant(received_at).alias("received_at"),
        origin("topic", "string").alias("topic"),
        origin("offset", "bigint").alias("kafka_offset"),
        origin("partition", "int").alias("partition"),
        F.col("error"),
        payload.alias("raw_message"),
    )


HALFFLOW_KEY_FIELDS = ["record_id", "community_id", "direction", "first_seen_us"]
FAULT_KEY_FIELDS = ["fault_id", "state"]

# What a fault may target, and the limits of its strength.
NETWORK_TARGETS = ("switch", "router", "circuit", "pop", "gateway")
SERVICE_TARGETS = ("server", "app")


def fault_rule_error(known: Column | None = None) -> Column:
    """Reason a fault event breaks the field rules, NULL if none. `known` says whether the
    target exists in the inventory."""

    def finite(name: str) -> Column:
        return ~F.isnan(name) & (F.abs(F.col(name)) != float("inf"))

    kind = F.col("target_type")
    all_finite = finite("latency_ms") & finite("loss") & finite("server_factor")
    reason = F.when(
        ~F.col("kind").isin("degrade", "down", "slow"), "kind must be degrade, down or slow"
    ).when(
        ~kind.isin(*NETWORK_TARGETS, *SERVICE_TARGETS), "unknown target type"
    )
    if known is not None:
        reason = reason.when(~known, "unknown target")
    return (
        reason.when((F.col("kind") == "down") & (kind != "circuit"), "down needs a circuit")
        .when(
            (F.col("kind") == "slow") & ~kind.isin(*SERVICE_TARGETS), "slow needs a server or app"
        )
        .when(
            (F.col("kind") == "degrade") & ~kind.isin(*NETWORK_TARGETS),
            "degrade needs a network element",
        )
        .when(~all_finite, "numbers must be finite")
        .when(~F.col("latency_ms").between(0, 10_000), "latency_ms out of range")
        .when(~((F.col("loss") >= 0) & (F.col("loss") < 0.5)), "loss out of range")
        .when(~F.col("server_factor").between(1, 100), "server_factor out of range")
    )
