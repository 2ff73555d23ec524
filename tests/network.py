"""A small literal network and half-flow builder shared by the tests."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from pathquality.functions.clock import micros_of
from pathquality.sources import schemas

T0 = datetime(2026, 3, 2, 10, 0)


def at(seconds: float) -> datetime:
    return T0 + timedelta(microseconds=round(seconds * 1e6))


def frame(spark: SparkSession, ddl: str, rows: list[dict]) -> DataFrame:
    names = [f.name for f in spark.createDataFrame([], ddl).schema]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)


INVENTORY_ROWS = {
    "providers": [{"code": "AAA", "name": "Alpha", "latency_factor": Decimal("1.00")},
                  {"code": "BBB", "name": "Beta", "latency_factor": Decimal("1.20")}],
    "pops": [{"pop_id": "AAA-N", "provider": "AAA", "region": "North", "backbone_ms": Decimal(5)},
             {"pop_id": "BBB-N", "provider": "BBB", "region": "North", "backbone_ms": Decimal(6)}],
    "gateways": [{"gateway_id": "GW-1", "dc": "dc1"}, {"gateway_id": "GW-2", "dc": "dc2"}],
    "branches": [
        {"branch_id": "BR-1", "index": 1, "region": "North", "size": "small",
         "lan_prefix": "10.1.0.0/24", "guest_prefix": "10.1.128.0/24", "router_id": "R-1",
         "switch_ids": "BR-1-SW1|BR-1-SW2", "primary_circuit_id": "CKT-11",
         "backup_circuit_id": "CKT-12"},
    ],
    "circuits": [
        {"circuit_id": "CKT-11", "tunnel_id": 11, "branch_id": "BR-1", "provider": "AAA",
         "pop_id": "AAA-N", "role": "primary", "bandwidth_mbps": 100, "access_ms": Decimal(2)},
        {"circuit_id": "CKT-12", "tunnel_id": 12, "branch_id": "BR-1", "provider": "BBB",
         "pop_id": "BBB-N", "role": "backup", "bandwidth_mbps": 20, "access_ms": Decimal(3)},
    ],
    "devices": [
        {"device_id": "ATM-1", "device_type": "atm", "branch_id": "BR-1", "switch_id": "BR-1-SW1",
         "ip": "10.1.0.20"},
        {"device_id": "G-1", "device_type": "guest", "branch_id": "BR-1",
         "switch_id": "BR-1-SW2", "ip": "10.1.128.9"},
    ],
    "servers": [{"server_id": "srv-1", "app": "pay", "dc": "dc1", "ip": "10.200.1.10"}],
    "apps": [
        {"name": "pay", "category": "card", "criticality": "critical", "ip_proto": 6, "l7": "TLS",
         "dst_port": 443, "hosted": "dc"},
        {"name": "mail", "category": "office", "criticality": "business", "ip_proto": 6,
         "l7": "TLS", "dst_port": 443, "hosted": "dc"},
    ],
    "sla_targets": [
        {"app": "pay", "response_good_ms": 200, "response_bad_ms": 600, "rtt_good_ms": 40,
         "rtt_bad_ms": 80, "retrans_good_pct": Decimal("0.50"),
         "retrans_bad_pct": Decimal("2.50")},
    ],
}


def inventory_tables(spark: SparkSession, **changes: list[dict]) -> dict[str, DataFrame]:
    rows = {**INVENTORY_ROWS, **changes}
    return {t: frame(spark, ddl, rows[t]) for t, ddl in schemas.INVENTORY.items()}


def record(cid: str, direction: str, first: float, seq: int = 0, final: bool = True, **over) -> dict:
    """One exported record. Times are seconds after T0; packet times only on record 0."""
    way = "c" if direction == "c2s" else "s"
    client, server = "10.1.0.20", "10.200.1.10"
    base = {
        "record_id": f"{cid}{way}{round(first * 1000) % 100000}x{seq}".rjust(16, "0")[-16:],
        "community_id": cid, "first_seen": at(first), "direction": direction,
        "record_seq": seq, "is_final": final, "probe_id": "GW-1" if way == "c" else "GW-2",
        "exported_at": at(first + 1), "flow_start": at(first), "flow_end": at(first + 1 + seq),
        "src_ip": client if way == "c" else server, "dst_ip": server if way == "c" else client,
        "src_port": 40000, "dst_port": 443, "ip_proto": 6, "tunnel_id": 11, "app": "pay",
        "app_category": "card", "l7_proto": "TLS", "bytes": 1000, "packets": 50,
        "retrans_packets": 0, "ingested_at": at(first + 5 + seq),
    }
    epoch = datetime(1970, 1, 1)
    for name in ("tcp_syn", "tcp_synack", "tcp_ack", "first_req", "first_resp"):
        base[name] = epoch
    if seq == 0 and way == "c":
        base.update(tcp_syn=at(first), tcp_ack=at(first + 0.060), first_req=at(first + 0.061))
    if seq == 0 and way == "s":
        base.update(tcp_synack=at(first + 0.020), first_resp=at(first + 0.161))
    base.update(over)
    return base


def halfflows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return frame(spark, schemas.HALFFLOWS, rows)


def us(seconds: float) -> int:
    return micros_of(at(seconds))
