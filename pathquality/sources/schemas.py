"""Table schemas as Spark DDL. Names and types other systems rely on."""

from __future__ import annotations

# One message on the half-flow topic. Unknown fields are ignored.
WIRE_HALFFLOW = """
    record_id string, community_id string, first_seen_us bigint, direction string,
    record_seq int, is_final int, probe_id string, exported_at_us bigint,
    flow_start_us bigint, flow_end_us bigint, src_ip string, dst_ip string,
    src_port int, dst_port int, ip_proto int, tunnel_id bigint, app string,
    app_category string, l7_proto string, bytes bigint, packets bigint,
    retrans_packets bigint, tcp_syn_us bigint, tcp_synack_us bigint, tcp_ack_us bigint,
    first_req_us bigint, first_resp_us bigint
"""

# One message on the fault topic.
WIRE_FAULT = """
    fault_id string, state string, event_at_us bigint, kind string, target string,
    target_type string, label string, source string, start_us bigint, end_us bigint,
    latency_ms double, loss double, server_factor double
"""

HALFFLOWS = """
    record_id string, community_id string, first_seen timestamp, direction string,
    record_seq int, is_final boolean, probe_id string, exported_at timestamp,
    flow_start timestamp, flow_end timestamp, src_ip string, dst_ip string,
    src_port int, dst_port int, ip_proto int, tunnel_id bigint, app string,
    app_category string, l7_proto string, bytes bigint, packets bigint,
    retrans_packets bigint, tcp_syn timestamp, tcp_synack timestamp, tcp_ack timestamp,
    first_req timestamp, first_resp timestamp, ingested_at timestamp
"""

QUEUE = "ingested_at timestamp, community_id string, first_seen timestamp"

INGEST_ERRORS = """
    received_at timestamp, topic string, kafka_offset bigint, partition int,
    error string, raw_message string
"""

FAULT_EVENTS = """
    fault_id string, state string, event_at timestamp, kind string, target string,
    target_type string, label string, source string, start_at timestamp, end_at timestamp,
    latency_ms double, loss double, server_factor double
"""

SESSIONS = """
    session_start timestamp, session_end timestamp, community_id string,
    stitched_at timestamp, complete boolean, asymmetric boolean, records int,
    client_ip string, server_ip string, client_port int, server_port int, ip_proto int,
    probe_c2s string, probe_s2c string, app string, app_category string,
    criticality string, l7_proto string, branch_id string, region string,
    branch_size string, segment string, router_id string, switch_id string,
    device_id string, device_type string, tunnel_id bigint, circuit_id string,
    circuit_role string, provider string, pop_id string, server_id string, dc string,
    bytes_c2s bigint, bytes_s2c bigint, packets_c2s bigint, packets_s2c bigint,
    retrans_c2s bigint, retrans_s2c bigint, retrans_pct double, server_rtt_ms double,
    client_rtt_ms double, response_ms double, quality int, degraded boolean,
    net_degraded boolean
"""

QUALITY_1M = """
    minute timestamp, branch_id string, region string, provider string, pop_id string,
    circuit_id string, circuit_role string, app string, criticality string,
    sessions bigint, degraded bigint, net_degraded bigint, bytes bigint, packets bigint,
    retrans bigint, quality_sum bigint, response_ms binary, client_rtt_ms binary,
    devices binary, degraded_devices binary
"""

ELEMENT_1M = """
    minute timestamp, element_type string, element_id string, sessions bigint,
    degraded bigint, response_ms binary, devices binary, degraded_devices binary,
    degraded_branches binary, degraded_apps array<string>
"""

JOURNAL = """
    seq bigint, job string, shard int, batch_id string, lo timestamp, hi timestamp,
    live_from timestamp, state string, updated_at timestamp
"""

ALERTS = """
    rule string, labels string, severity string, value double, state string, previous string,
    since timestamp, evaluated_at timestamp
"""

COMPACTIONS = "table_name string, day date, from_batch string"

INVENTORY = {
    "providers": "code string, name string, latency_factor decimal(4,2)",
    "pops": "pop_id string, provider string, region string, backbone_ms decimal(6,2)",
    "gateways": "gateway_id string, dc string",
    "branches": (
        "branch_id string, index int, region string, size string, lan_prefix string, "
        "guest_prefix string, router_id string, switch_ids string, "
        "primary_circuit_id string, backup_circuit_id string"
    ),
    "circuits": (
        "circuit_id string, tunnel_id bigint, branch_id string, provider string, "
        "pop_id string, role string, bandwidth_mbps int, access_ms decimal(6,2)"
    ),
    "devices": (
        "device_id string, device_type string, branch_id string, switch_id string, ip string"
    ),
    "servers": "server_id string, app string, dc string, ip string",
    "apps": (
        "name string, category string, criticality string, ip_proto int, l7 string, "
        "dst_port int, hosted string"
    ),
    "sla_targets": (
        "app string, response_good_ms int, response_bad_ms int, rtt_good_ms int, "
        "rtt_bad_ms int, retrans_good_pct decimal(5,2), retrans_bad_pct decimal(5,2)"
    ),
}
