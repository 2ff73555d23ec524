"""Queries over half-flows and messages."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import instant
from ..functions.network import community_id, ipv4_number
from ..functions.quality import add_score, add_timings
from ..operators.asof import asof_join, asof_join_within, range_join_nearest
from ..operators.keyed import latest_per_key
from ..operators.lookup import longest_prefix_match, lookup, prefix_table
from ..operators.quantile import exact_quantile
from ..operators.sizing import MAX_ROWS
from ..operators.slices import in_slices, oldest_needed
from ..plans import alerts, audits, panels
from ..plans.incidents import annotations, incidents, recent
from ..plans.localise import best_by_period, hit_rate
from ..plans.stitch import (
    Window,
    drop_replays,
    enrich,
    fold_halves,
    not_yet_emitted,
    quiet_since,
    pair_halves,
    ready,
    stitch_window,
)
from ..settings import GENERIC_SLA
from ..sources import schemas, wire
from ..sources.store import retained
from . import views as v
from .registry import query

EVENTS_START, EVENTS_END = datetime(2023, 12, 31), datetime(2024, 2, 1)
CLOSED = datetime(2024, 1, 30, 12, 0)


# --- messages -----------------------------------------------------------------------

# One JSON message per event. The event's own property decides what is wrong with it.
MESSAGE_SQL = """
    keyed AS (
        SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
            CASE WHEN event_type IN ('click', 'view') THEN 'c2s'
                 WHEN event_type = 'error' THEN 'sideways' ELSE 's2c' END AS way
        FROM events
    ),
    fields AS (
        SELECT *, lpad(CAST(event_id AS VARCHAR), CASE WHEN k BETWEEN 10 AND 19 THEN 12 ELSE 16 END, '0')
                AS record_id,
            CASE WHEN k BETWEEN 20 AND 24 THEN '' ELSE 'u' || CAST(user_id AS VARCHAR) END
                AS community_id,
            epoch_us(ts) AS first_seen_us
        FROM keyed
    ),
    judged AS (
        SELECT *, CASE WHEN k < 5 THEN 'unparsable message'
            WHEN strlen(record_id) <> 16 THEN 'invalid record_id'
            WHEN way NOT IN ('c2s', 's2c') THEN 'invalid direction'
            WHEN community_id = '' THEN 'missing community_id'
            WHEN first_seen_us NOT BETWEEN epoch_us(TIMESTAMP '2024-01-20') - 604800000000
                 AND epoch_us(TIMESTAMP '2024-01-20') + 3600000000
            THEN 'first_seen_us outside the accepted window' END AS error
        FROM fields
    )
"""
MESSAGES_NOW = datetime(2024, 1, 20)


def messages(spark, folder: str) -> DataFrame:
    ev = v.table(spark, folder, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    way = (
        F.when(F.col("event_type").isin("click", "view"), "c2s")
        .when(F.col("event_type") == "error", "sideways")
        .otherwise("s2c")
    )
    digits = F.when(k.between(10, 19), 12).otherwise(16)
    body = F.to_json(
        F.struct(
            F.lpad(F.col("event_id").cast("string"), digits, F.lit("0")).alias("record_id"),
            F.when(k.between(20, 24), "").otherwise(v.text("u", F.col("user_id"))).alias("community_id"),
            F.unix_micros("ts").alias("first_seen_us"),
            way.alias("direction"),
            (F.col("event_id") % 5).alias("record_seq"),
            F.when(F.col("event_id") % 2 == 0, 1).otherwise(0).alias("is_final"),
            F.lit("unknown field").alias("colour"),
            F.round(F.col("value") * 100).cast("bigint").alias("bytes"),
        )
    )
    return ev.select(
        F.when(k < 5, F.concat(F.lit('{"record_id": '), "event_id")).otherwise(body).alias("value"),
        F.lit("flows").alias("topic"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def parsed(spark, folder: str) -> DataFrame:
    return wire.parse_halfflows(messages(spark, folder), MESSAGES_NOW)


@query(
    "parse_records",
    f"""WITH {MESSAGE_SQL}
    SELECT event_id AS "offset",
        CASE WHEN k < 5 THEN '' ELSE record_id END AS record_id,
        CASE WHEN k < 5 THEN '' ELSE community_id END AS community_id,
        CASE WHEN k < 5 THEN 0 ELSE first_seen_us END AS first_seen_us,
        CASE WHEN k < 5 THEN '' ELSE way END AS direction,
        CASE WHEN k < 5 THEN 0 ELSE CAST(event_id % 5 AS INTEGER) END AS record_seq,
        CASE WHEN k < 5 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS bytes,
        CAST(0 AS BIGINT) AS tcp_syn_us, coalesce(error, 'ok') AS error
    FROM judged""",
)
def parse_records(spark, folder):
    return parsed(spark, folder).select(
        "offset", "record_id", "community_id", "first_seen_us", "direction", "record_seq", "bytes",
        "tcp_syn_us", F.coalesce("error", F.lit("ok")).alias("error"),
    )


@query(
    "accept_records",
    f"""WITH {MESSAGE_SQL}
    SELECT record_id, community_id, ts AS first_seen, way AS direction,
        event_id % 2 = 0 AS is_final, '0.0.0.0' AS src_ip, TIMESTAMP '1970-01-01' AS tcp_syn,
        TIMESTAMP '2024-01-20' AS ingested_at
    FROM judged WHERE error IS NULL""",
)
def accept_records(spark, folder):
    return wire.accepted_halfflows(parsed(spark, folder), MESSAGES_NOW).select(
        "record_id", "community_id", "first_seen", "direction", "is_final", "src_ip", "tcp_syn",
        "ingested_at",
    )


@query(
    "quarantine",
    f"""WITH {MESSAGE_SQL}
    SELECT 'flows' AS topic, event_id AS kafka_offset, CAST(event_id % 8 AS INTEGER) AS "partition",
        error, CASE WHEN k < 5 THEN '{{"record_id": ' || CAST(event_id AS VARCHAR)
        ELSE '{{"record_id":"' || record_id || '","community_id":"' || community_id
            || '","direction":"' || way || '","first_seen_us":"' || CAST(first_seen_us AS VARCHAR)
            || '"}}' END AS raw_message
    FROM judged WHERE error IS NOT NULL""",
)
def quarantine(spark, folder):
    return wire.refused(parsed(spark, folder), wire.HALFFLOW_KEY_FIELDS, MESSAGES_NOW).drop(
        "received_at"
    )


FAULT_MESSAGE_SQL = """
    fault_messages AS (
        SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '' ELSE 'f' || CAST(user_id AS VARCHAR) END AS fault_id,
            CASE event_type WHEN 'error' THEN 'odd' WHEN 'signup' THEN 'started' ELSE 'ended' END AS state,
            ts AS event_at, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) < 5 AS broken
        FROM events
    )
"""


def fault_messages(spark, folder: str) -> DataFrame:
    ev = v.table(spark, folder, "events")
    state = F.when(F.col("event_type") == "error", "odd").when(
        F.col("event_type") == "signup", "started").otherwise("ended")
    body = F.to_json(F.struct(
        F.when(F.col("event_id") % 11 == 0, "").otherwise(v.text("f", F.col("user_id"))).alias("fault_id"),
        state.alias("state"), F.unix_micros("ts").alias("event_at_us")))
    broken = F.regexp_extract("props", "[0-9]+", 0).cast("int") < 5
    return ev.select(
        F.when(broken, F.concat(F.lit('{"fault_id": '), "event_id")).otherwise(body).alias("value"),
        F.col("event_id").alias("offset"))


@query(
    "fault_refusals",
    f"""WITH {FAULT_MESSAGE_SQL}
    SELECT event_id AS kafka_offset, CASE WHEN broken THEN 'unparsable message'
            WHEN fault_id = '' THEN 'missing fault_id' ELSE 'invalid state' END AS error,
        CASE WHEN broken THEN '{{"fault_id": ' || CAST(event_id AS VARCHAR)
            ELSE '{{"fault_id":"' || fault_id || '","state":"' || state || '"}}' END AS raw_message
    FROM fault_messages WHERE broken OR fault_id = '' OR state = 'odd'""",
)
def fault_refusals(spark, folder):
    read = wire.parse_faults(fault_messages(spark, folder))
    return wire.refused(read, wire.FAULT_KEY_FIELDS, MESSAGES_NOW).select("kafka_offset", "error", "raw_message")


@query(
    "fault_events_sink",
    f"""WITH {FAULT_MESSAGE_SQL}
    SELECT fault_id, state, max(event_at) AS event_at FROM fault_messages
    WHERE NOT broken AND fault_id <> '' AND state <> 'odd' GROUP BY fault_id, state""",
)
def fault_events_sink(spark, folder):
    """Accepted fault messages; the last to happen of a fault and state counts."""
    good = wire.accepted_faults(wire.parse_faults(fault_messages(spark, folder)))
    return latest_per_key(good, ["fault_id", "state"], ["event_at"]).select("fault_id", "state", "event_at")


@query(
    "community_id",
    """SELECT event_id, '1:' || to_base64(unhex(sha1(unhex(
        '0000' || CASE WHEN dst < src THEN printf('%08x', dst) || printf('%08x', src)
                       ELSE printf('%08x', src) || printf('%08x', dst) END
        || '0600' || CASE WHEN dst < src THEN printf('%04x', 443) || printf('%04x', port)
                          ELSE printf('%04x', port) || printf('%04x', 443) END)))) AS community_id
    FROM (SELECT event_id, 167772160 + user_id AS src, 180879360 - event_id % 2 * 100000000 AS dst,
                 1024 + user_id % 50000 AS port FROM events)""",
)
def community_ids(spark, folder):
    ev = v.table(spark, folder, "events")
    user = F.col("user_id")
    src = v.text("10.", F.floor(user / 65536), ".", F.floor(user / 256) % 256, ".", user % 256)
    # the second server address is the first one less 100,000,000
    dst = F.when(F.col("event_id") % 2 == 0, "10.200.0.0").otherwise("4.210.31.0")
    return ev.select(
        "event_id",
        community_id(src, dst, 1024 + user % 50000, F.lit(443), F.lit(6)).alias("community_id"),
    )


# --- queue --------------------------------------------------------------------------


def queue(spark, folder: str) -> DataFrame:
    return wire.queue_rows(v.halfflows(spark, folder))


SLICE_SQL = " OR ".join(
    f"(ingested_at > TIMESTAMP '2024-01-10' - INTERVAL {o} SECOND"
    f" AND ingested_at <= TIMESTAMP '2024-01-20' - INTERVAL {o} SECOND)"
    for o in (0, 60, 300, 900)
)
SLICE_WINDOW = (datetime(2024, 1, 10), datetime(2024, 1, 20))


def touched(spark, folder: str) -> DataFrame:
    lo, hi = SLICE_WINDOW
    slices = in_slices(F.col("ingested_at"), lo, hi, v.FLOW_SETTINGS.slice_offsets_s)
    return queue(spark, folder).filter(slices)


@query(
    "queue_slices",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT ingested_at, community_id, first_seen FROM hf WHERE {SLICE_SQL}""",
)
def queue_slices(spark, folder):
    return touched(spark, folder)


@query(
    "queue_since",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT greatest(TIMESTAMP '2024-01-20' - INTERVAL 86400 SECOND,
                    min(first_seen) - INTERVAL 50400 SECOND) AS since, count(*) AS queued
    FROM hf WHERE {SLICE_SQL}""",
)
def queue_since(spark, folder):
    return oldest_needed(touched(spark, folder), SLICE_WINDOW[1], 86_400, 50_400_000)


@query(
    "tumbling_windows",
    """SELECT width, start, count(*) AS n,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM (
        SELECT 'minute' AS width, date_trunc('minute', ts) AS start, value FROM events
        UNION ALL SELECT 'hour', date_trunc('hour', ts), value FROM events
        UNION ALL SELECT '10 seconds', make_timestamp(epoch_us(ts) // 10000000 * 10000000), value
        FROM events
    ) WHERE start < TIMESTAMP '2024-01-30 12:00:00' GROUP BY width, start""",
)
def tumbling_windows(spark, folder):
    ev = v.table(spark, folder, "events")
    starts = F.array(
        F.struct(F.lit("minute").alias("width"), F.date_trunc("minute", "ts").alias("start")),
        F.struct(F.lit("hour").alias("width"), F.date_trunc("hour", "ts").alias("start")),
        F.struct(
            F.lit("10 seconds").alias("width"),
            F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 10) * 10).alias("start"),
        ),
    )
    cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
    return (
        ev.select(cents, F.inline(starts))
        .filter(F.col("start") < instant(CLOSED))
        .groupBy("width", "start")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"))
    )


@query(
    "ingest_rate_10s",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT make_timestamp(epoch_us(ingested_at) // 10000000 * 10000000) AS "time", probe_id,
        count(*) / 10 AS rows_per_s
    FROM hf WHERE ingested_at < TIMESTAMP '2024-01-30 12:00:00' GROUP BY ALL""",
)
def ingest_rate_10s(spark, folder):
    return panels.ingest_rate_series(
        v.halfflows(spark, folder), EVENTS_START, EVENTS_END, CLOSED, part="probe_id"
    )


@query(
    "ingest_rate",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT count(*) / 2678400 AS rows_per_s FROM hf WHERE ingested_at >= TIMESTAMP '2024-01-01'""",
)
def ingest_rate(spark, folder):
    return panels.ingest_rate(queue(spark, folder), datetime(2024, 2, 1), 31 * 86_400)


@query(
    "retention_filter",
    """SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-23'""",
)
def retention_filter(spark, folder):
    ev = v.table(spark, folder, "events").select("event_id", "ts")
    return retained(ev, "ts", datetime(2024, 1, 30, 18), 7)


# --- halves -------------------------------------------------------------------------


@query(
    "dedup_replay",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT record_id, community_id, direction, ingested_at, bytes FROM hf
    QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ingested_at) = 1""",
)
def dedup_replay(spark, folder):
    rows = v.halfflows(spark, folder).select(
        "record_id", "community_id", "direction", "ingested_at", "bytes"
    )
    return drop_replays(rows)


HALF_COLUMNS = (
    "community_id, first_seen, direction, probe_id, src_ip, tunnel_id, app, bytes, packets, "
    "retrans, whole, n_records, last_seen, last_ingest, syn_us, synack_us, ack_us, req_us, resp_us"
)


def halves(spark, folder: str) -> DataFrame:
    return fold_halves(drop_replays(v.halfflows(spark, folder)))


def paired(spark, folder: str) -> DataFrame:
    s = v.FLOW_SETTINGS
    return pair_halves(halves(spark, folder), s.pair_tolerance_ms, s.probe_skew_ms)


@query("fold_halves", f"WITH {v.PAIRED_SQL} SELECT {HALF_COLUMNS} FROM halves")
def folded(spark, folder):
    return halves(spark, folder).select(*HALF_COLUMNS.split(", "))


@query(
    "pair_halves",
    f"""WITH {v.PAIRED_SQL}
    SELECT community_id, first_seen, matched, whole, s_whole, s_probe, s_bytes, s_records,
        s_last_seen, s_last_ingest, s_synack_us, s_resp_us FROM paired""",
)
def pairs(spark, folder):
    return paired(spark, folder).select(
        "community_id", "first_seen", "matched", "whole", "s_whole", "s_probe", "s_bytes",
        "s_records", "s_last_seen", "s_last_ingest", "s_synack_us", "s_resp_us",
    )


def clicks_and_purchases(spark, folder: str):
    ev = v.table(spark, folder, "events")
    ends = F.col("event_type").isin("purchase", "signup")
    left = ev.filter(~ends).select("event_id", "user_id", "ts")
    right = ev.filter(ends).select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("purchase_id")
    )
    return left, right


def no_null_ids(df: DataFrame) -> DataFrame:
    """Missing integer ids compare differently between engines' result frames."""
    return df.withColumn("r_purchase_id", F.coalesce("r_purchase_id", F.lit(-1)))


ASOF_SQL = """
    FROM (SELECT event_id, user_id, ts, ts - INTERVAL {skew} SECOND AS from_ts
          FROM events WHERE event_type NOT IN ('purchase', 'signup')) l
    ASOF LEFT JOIN (SELECT user_id, ts AS at, event_id AS purchase_id
                    FROM events WHERE event_type IN ('purchase', 'signup')) r
        ON l.user_id = r.user_id AND l.from_ts <= r.at
"""
NEAR = "abs(epoch_us(r.at) // 1000 - epoch_us(l.ts) // 1000) <= 21600000"
TOLERANCE_SQL = f"""SELECT l.event_id, l.user_id, l.ts,
        CASE WHEN {NEAR} THEN r.at END AS r_at,
        coalesce(CASE WHEN {NEAR} THEN r.purchase_id END, -1) AS r_purchase_id,
        coalesce({NEAR}, FALSE) AS r_matched {ASOF_SQL.format(skew=600)}"""


@query(
    "asof_join",
    f"""SELECT l.event_id, l.user_id, l.ts, r.at AS r_at, coalesce(r.purchase_id, -1) AS r_purchase_id,
        r.at IS NOT NULL AS r_matched {ASOF_SQL.format(skew=0)}""",
)
def asof(spark, folder):
    left, right = clicks_and_purchases(spark, folder)
    return no_null_ids(asof_join(left, right, ["user_id"], "ts", "at"))


@query("asof_join_tolerance", TOLERANCE_SQL)
def asof_tolerance(spark, folder):
    left, right = clicks_and_purchases(spark, folder)
    return no_null_ids(
        asof_join_within(left, right, ["user_id"], "ts", "at", 21_600_000, 600_000)
    )


@query("asof_join_range_form", TOLERANCE_SQL)
def asof_range_form(spark, folder):
    left, right = clicks_and_purchases(spark, folder)
    return no_null_ids(
        range_join_nearest(left, right, ["user_id"], ["event_id"], "ts", "at", 21_600_000, 600_000)
    )


@query(
    "semi_join",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT record_id, community_id, ingested_at FROM hf WHERE community_id IN (
        SELECT community_id FROM hf WHERE ingested_at <= TIMESTAMP '2024-01-03')""",
)
def semi_join(spark, folder):
    early = queue(spark, folder).filter(F.col("ingested_at") <= instant(datetime(2024, 1, 3)))
    ids = early.select("community_id").distinct()
    return (
        v.halfflows(spark, folder)
        .select("record_id", "community_id", "ingested_at")
        .join(ids, "community_id", "left_semi")
    )


EARLIER = datetime(2024, 1, 15)
# Sessions an earlier run would have written.
EARLIER_SQL = "SELECT community_id, first_seen AS session_start FROM paired WHERE matched AND whole AND s_whole AND first_seen < TIMESTAMP '2024-01-15'"


def earlier_sessions(done: DataFrame) -> DataFrame:
    complete = F.col("matched") & F.col("whole") & F.col("s_whole")
    return done.filter(complete & (F.col("first_seen") < instant(EARLIER))).select(
        "community_id", F.col("first_seen").alias("session_start")
    )


@query(
    "anti_join",
    f"""WITH {v.PAIRED_SQL}, earlier AS ({EARLIER_SQL})
    SELECT community_id, first_seen, bytes FROM paired p WHERE NOT EXISTS (
        SELECT 1 FROM earlier e WHERE e.community_id = p.community_id
            AND e.session_start = p.first_seen)""",
)
def anti_join(spark, folder):
    rows = paired(spark, folder)
    return not_yet_emitted(rows, earlier_sessions(rows)).select(
        "community_id", "first_seen", "bytes"
    )


@query(
    "anti_join_live",
    f"""WITH {v.PAIRED_SQL}
    SELECT community_id, first_seen, bytes FROM paired p WHERE (
        SELECT max(ingested_at) FROM hf WHERE hf.community_id = p.community_id)
        <= TIMESTAMP '2024-01-30'""",
)
def anti_join_live(spark, folder):
    """A repair leaves out what live stitching may still touch."""
    quiet = quiet_since(paired(spark, folder), queue(spark, folder), datetime(2024, 1, 30))
    return quiet.select("community_id", "first_seen", "bytes")


@query(
    "nth_record",
    f"WITH {v.HALFFLOW_SQL} SELECT record_id FROM hf ORDER BY record_id LIMIT 1 OFFSET 100",
)
def nth_record(spark, folder):
    return v.halfflows(spark, folder).select("record_id").orderBy("record_id").offset(100).limit(1)


@query(
    "lost_sessions_audit",
    f"""WITH {v.PAIRED_SQL}, earlier AS ({EARLIER_SQL})
    SELECT count(*) AS lost FROM (
        SELECT DISTINCT community_id, first_seen FROM hf h
        WHERE direction = 'c2s' AND is_final
            AND ingested_at BETWEEN TIMESTAMP '2023-12-31' AND TIMESTAMP '2024-02-01'
            AND NOT EXISTS (SELECT 1 FROM earlier e WHERE e.community_id = h.community_id
                AND e.session_start = h.first_seen))""",
)
def lost_sessions_audit(spark, folder):
    emitted = earlier_sessions(paired(spark, folder))
    return audits.lost_sessions(v.halfflows(spark, folder), emitted, EVENTS_START, EVENTS_END)


# --- sessions -----------------------------------------------------------------------

# The queue window covers all events, so only its end matters.
TOUCHED_SQL = """hf WHERE community_id IN (
            SELECT community_id FROM hf
            WHERE ingested_at BETWEEN TIMESTAMP '2023-11-30 23:45:00.000001' AND TIMESTAMP '2024-01-30 23:59:00')"""


def component_sql(number: int, name: str, weight: str, value: str) -> str:
    """One component of the score, for the sessions that have it: 1 if good, 0 if bad."""
    return f"""SELECT community_id, first_seen, {number} AS part, {weight} AS weight,
            greatest(0, least(1, ({name}_bad{UNIT[name]} - {value})
                / ({name}_bad{UNIT[name]} - {name}_good{UNIT[name]}))) AS share
        FROM measured WHERE {value} IS NOT NULL"""


UNIT = {"response": "_ms", "rtt": "_ms", "retrans": "_pct"}
# Targets of an application without any.
TARGETS = {"response_good_ms": 300, "response_bad_ms": 1000, "rtt_good_ms": 40, "rtt_bad_ms": 100,
           "retrans_good_pct": 1, "retrans_bad_pct": 3}
STITCHED_SQL = f"""{v.paired_sql(TOUCHED_SQL)}, {v.INVENTORY_SQL},
    emitted AS (
        SELECT *, whole AND s_whole AS complete FROM paired
        WHERE whole AND s_whole
            OR greatest(last_ingest, s_last_ingest) + INTERVAL 900 SECOND < TIMESTAMP '2024-01-30 23:59:00'
    ),
    clients AS (
        SELECT DISTINCT src_ip, 167772160 + CAST(substr(community_id, 2) AS BIGINT) AS num FROM emitted
    ),
    sites AS (
        SELECT src_ip, num, p.branch_id, p.segment FROM clients
        JOIN inv_prefixes p ON (num - p.net) BETWEEN 0 AND (1 << (32 - p.len)) - 1
        QUALIFY p.len = max(p.len) OVER (PARTITION BY num)
    ),
    located AS (
        SELECT c.src_ip, c.num, coalesce(t.branch_id, '') AS branch_id, coalesce(t.segment, '') AS segment,
            coalesce(b.region, '') AS region, coalesce(b.size, '') AS branch_size,
            coalesce(b.router_id, '') AS router_id, coalesce(d.switch_id, '') AS switch_id,
            coalesce(d.device_id, CASE t.segment WHEN 'guest' THEN t.branch_id || '-GUEST-' || c.src_ip END, '')
                AS device_id,
            coalesce(d.device_type, CASE t.segment WHEN 'guest' THEN 'guest' END, 'unknown') AS device_type
        FROM clients c LEFT JOIN sites t USING (num) LEFT JOIN inv_branches b USING (branch_id)
        LEFT JOIN inv_devices d ON d.ip_num = c.num
    ),
    measured AS (
        SELECT e.*, {", ".join(f"coalesce(a.{c}, {x}) AS {c}" for c, x in TARGETS.items())},
            coalesce(a.criticality, 'unknown') AS criticality,
            e.ip_proto = 6 AND NOT e.matched AS silent,
            {", ".join(f"CASE WHEN e.ip_proto = 6 AND e.matched AND least({x}, {y} - {x}) > 0 THEN ({y} - {x}) / 1000 END AS {n}"
                       for n, x, y in (("server_rtt_ms", "syn_us", "s_synack_us"),
                                       ("client_rtt_ms", "s_synack_us", "ack_us"),
                                       ("response_ms", "req_us", "s_resp_us")))},
            1e2 * (retrans + s_retrans) / greatest(1, packets + s_packets) AS lost
        FROM emitted e LEFT JOIN inv_apps a ON a.name = e.app
    ),
    components AS (
        {component_sql(1, "response", "4e-1", "response_ms")}
        UNION ALL {component_sql(2, "rtt", "4e-1", "client_rtt_ms")}
        UNION ALL {component_sql(3, "retrans", "2e-1", "lost")}
    ),
    scores AS (
        SELECT community_id, first_seen, CAST(round_even(
            1e2 * sum(share * weight ORDER BY part) / sum(weight ORDER BY part), 0) AS INTEGER) AS points
        FROM components GROUP BY ALL
    ),
    stitched AS (
        SELECT m.community_id, m.first_seen AS session_start, greatest(last_seen, s_last_seen) AS session_end,
            TIMESTAMP '2024-01-31' AS stitched_at, complete, ip_proto, tunnel_id, l7_proto, m.app,
            app_category, criticality, matched AND probe_id <> s_probe AS asymmetric,
            CAST(n_records + s_records AS INTEGER) AS records,
            m.src_ip AS client_ip, src_port AS client_port, dst_ip AS server_ip, dst_port AS server_port,
            probe_id AS probe_c2s, bytes AS bytes_c2s, packets AS packets_c2s, retrans AS retrans_c2s,
            s_probe AS probe_s2c, s_bytes AS bytes_s2c, s_packets AS packets_s2c, s_retrans AS retrans_s2c,
            l.segment, l.branch_id, l.branch_size, l.region, l.router_id, l.switch_id, l.device_type,
            l.device_id, coalesce(k.circuit_id, '') AS circuit_id,
            coalesce(k.role, '') AS circuit_role, coalesce(k.provider, '') AS provider,
            coalesce(k.pop_id, '') AS pop_id, coalesce(v.server_id, '') AS server_id,
            coalesce(v.dc, 'internet') AS dc, lost AS retrans_pct, server_rtt_ms, client_rtt_ms, response_ms,
            CASE WHEN silent THEN 0 ELSE points END AS quality,
            silent OR points < 70 AS degraded,
            silent OR lost > retrans_bad_pct OR coalesce(client_rtt_ms > rtt_bad_ms, FALSE) AS net_degraded
        FROM measured m JOIN scores USING (community_id, first_seen)
        JOIN located l ON l.num = 167772160 + CAST(substr(m.community_id, 2) AS BIGINT) AND l.src_ip = m.src_ip
        LEFT JOIN inv_circuits k USING (tunnel_id)
        LEFT JOIN inv_servers v ON v.ip_num - 180879360 = CAST(string_split(dst_ip, '.')[4] AS BIGINT)
    )
"""


def stitched(spark, folder: str) -> DataFrame:
    """The stitch kernel over everything at once."""
    flows = v.halfflows(spark, folder)
    nothing = flows.select("community_id", F.col("first_seen").alias("session_start")).limit(0)
    return stitch_window(
        flows,
        wire.queue_rows(flows),
        nothing,
        v.inventory(spark, folder),
        Window(v.FLOW_LO, v.FLOW_HI),
        v.FLOW_NOW,
        v.FLOW_SETTINGS,
    )


@query("stitch_sessions", f"WITH {STITCHED_SQL} SELECT * FROM stitched")
def stitch_sessions(spark, folder):
    return stitched(spark, folder)


@query("stitch_windows", f"WITH {STITCHED_SQL} SELECT community_id, session_start FROM stitched")
def stitch_windows(spark, folder):
    """The same time in two windows, the second of which leaves out what the first has written:
    together they emit every session once."""
    flows = v.halfflows(spark, folder)
    written = flows.select("community_id", F.col("first_seen").alias("session_start")).limit(0)
    for lo, hi in ((v.FLOW_LO, EARLIER), (EARLIER, v.FLOW_HI)):
        made = stitch_window(flows, wire.queue_rows(flows), written, v.inventory(spark, folder),
                             Window(lo, hi), v.FLOW_NOW, v.FLOW_SETTINGS)
        if made is not None:
            written = written.unionByName(made.select("community_id", "session_start"))
    return written


def due(spark, folder: str) -> DataFrame:
    return ready(paired(spark, folder), v.FLOW_HI, v.FLOW_SETTINGS.idle_timeout_s)


@query(
    "session_timings",
    f"""WITH {STITCHED_SQL}
    SELECT community_id, first_seen, silent AS no_return, server_rtt_ms AS server_rtt,
        client_rtt_ms AS client_rtt, response_ms AS response, lost AS retrans_share
    FROM measured""",
)
def session_timings(spark, folder):
    return add_timings(due(spark, folder)).select(
        "community_id", "first_seen", "no_return", "server_rtt", "client_rtt", "response",
        "retrans_share",
    )


@query(
    "quality_score",
    f"""WITH {STITCHED_SQL}
    SELECT community_id, session_start AS first_seen, quality, degraded, net_degraded FROM stitched""",
)
def quality_score(spark, folder):
    timed = add_timings(due(spark, folder))
    targets = {c: (c, default) for c, default in GENERIC_SLA.items()}
    apps = v.inventory(spark, folder).apps
    scored = add_score(lookup(timed, apps, {"app": "name"}, targets), 70)
    return scored.select("community_id", "first_seen", "quality", "degraded", "net_degraded")


@query(
    "enrich_sessions",
    f"""WITH {STITCHED_SQL}
    SELECT community_id, session_start AS first_seen, branch_id, segment, region, router_id, switch_id,
        device_id, device_type, server_id, dc, circuit_id, circuit_role, provider, pop_id, criticality
    FROM stitched""",
)
def enrich_sessions(spark, folder):
    return enrich(due(spark, folder), v.inventory(spark, folder)).select(
        "community_id", "first_seen", "branch_id", "segment", "region", "router_id", "switch_id",
        "device_id", "device_type", "server_id", "dc", "circuit_id", "circuit_role", "provider",
        "pop_id", "criticality",
    )


@query(
    "session_integrity_audit",
    f"""WITH {STITCHED_SQL}
    SELECT CAST(count(*) - count(DISTINCT (community_id, session_start)) AS BIGINT) AS duplicates,
        count_if(NOT complete) / count(*) AS incomplete_share,
        CAST(count_if(branch_id = '' OR circuit_id = '' OR device_type = 'unknown') AS BIGINT)
            AS unenriched
    FROM stitched""",
)
def session_integrity_audit(spark, folder):
    return audits.session_integrity(stitched(spark, folder), EVENTS_START, EVENTS_END)


LPM_SQL = f"""WITH {v.INVENTORY_SQL}
    SELECT event_id, coalesce(arg_max(p.branch_id, p.len), '') AS branch_id,
        coalesce(arg_max(p.segment, p.len), '') AS segment
    FROM (SELECT event_id, 167772160 + user_id AS ip FROM events) e
    LEFT JOIN inv_prefixes p ON e.ip >= p.net AND e.ip < p.net + CAST(pow(2, 32 - p.len) AS BIGINT)
    GROUP BY event_id"""


def _lpm(spark, folder: str, limit: int) -> DataFrame:
    ev = v.table(spark, folder, "events")
    user = F.col("user_id")
    ip = v.text("10.", F.floor(user / 65536), ".", F.floor(user / 256) % 256, ".", user % 256)
    prefixes = prefix_table(v.inventory(spark, folder).prefixes, "prefix", "branch_id", "segment")
    take = {"branch_id": ("branch_id", ""), "segment": ("segment", "")}
    found = longest_prefix_match(
        ev.select("event_id", ip.alias("ip")), ipv4_number(F.col("ip")), prefixes, take, limit
    )
    return found.select("event_id", "branch_id", "segment")


@query("lpm_join", LPM_SQL)
def lpm_join(spark, folder):
    return _lpm(spark, folder, MAX_ROWS)


@query("lpm_join_large_table", LPM_SQL)
def lpm_join_large_table(spark, folder):
    """The path a prefix table too large to broadcast takes."""
    return _lpm(spark, folder, 0)


# --- pipeline health ----------------------------------------------------------------


@query(
    "freshness_p95",
    """SELECT date_trunc('minute', ts + to_seconds(event_id % 600)) AS "time",
        round_even(quantile_cont(CAST((event_id % 600) * 1000 AS DOUBLE), 0.95) * 1e3, 0) / 1e6
            AS seconds
    FROM events GROUP BY 1""",
)
def freshness_p95(spark, folder):
    ev = v.table(spark, folder, "events")
    late = F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 600) * 1_000_000)
    rows = ev.select(
        F.col("ts").alias("session_start"), F.col("ts").alias("session_end"), late.alias("stitched_at")
    )
    late = panels.freshness_p95(rows, EVENTS_START, EVENTS_END, exact_quantile)
    return late.withColumn("seconds", F.rint(F.col("seconds") * 1e6) / 1e6)


def watermarks(spark, folder: str) -> DataFrame:
    ev = v.table(spark, folder, "events")
    return ev.select(
        F.lit("stitch").alias("job"),
        (F.col("event_id") % 4).cast("int").alias("shard"),
        F.date_trunc("hour", "ts").alias("watermark"),
        F.col("ts").alias("updated_at"),
    )


LAG_SQL = """SELECT CASE WHEN count(*) < {expected} THEN {missing}
        ELSE epoch_us(TIMESTAMP '2024-01-31') // 1000000 - min(w) END AS lag_s
    FROM (SELECT arg_max(epoch_us(date_trunc('hour', ts)) // 1000000, ts) AS w
          FROM events GROUP BY event_id % 4)"""


@query("stitch_lag", LAG_SQL.format(expected=4, missing="NULL"))
def stitch_lag(spark, folder):
    return panels.stitch_lag(watermarks(spark, folder), datetime(2024, 1, 31), expected=4)


@query("alert_stitch_lag", LAG_SQL.format(expected=5, missing=86400))
def alert_stitch_lag(spark, folder):
    return alerts.lagging(watermarks(spark, folder), datetime(2024, 1, 31), expected=5)


def refusals(spark, folder: str) -> DataFrame:
    ev = v.table(spark, folder, "events").filter(F.col("event_type") == "error")
    return ev.select(F.col("ts").alias("received_at"))


@query(
    "alert_ingest_errors",
    """SELECT count(*) AS errors FROM events
    WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-31' - INTERVAL 43200 MINUTE""",
)
def alert_ingest_errors(spark, folder):
    return alerts.ingest_errors(refusals(spark, folder), datetime(2024, 1, 31), 43_200)


@query(
    "errors_in_24h",
    """SELECT count(*) AS errors FROM events
    WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY""",
)
def errors_in_24h(spark, folder):
    return panels.errors_since(refusals(spark, folder), CLOSED)


@query(
    "alert_ingest_stopped",
    f"""WITH {v.HALFFLOW_SQL}
    SELECT count(*) AS records FROM hf
    WHERE ingested_at >= TIMESTAMP '2024-02-10' - INTERVAL 14400 MINUTE""",
)
def alert_ingest_stopped(spark, folder):
    return alerts.ingest_stopped(queue(spark, folder), datetime(2024, 2, 10), 14_400)


@query(
    "sessions_stitched",
    f"""WITH {STITCHED_SQL}
    SELECT count(*) AS sessions FROM stitched
    WHERE stitched_at >= TIMESTAMP '2024-01-31 01:00:00' - INTERVAL 480 HOUR
        AND session_start >= TIMESTAMP '2024-01-31 01:00:00' - INTERVAL 504 HOUR""",
)
def sessions_stitched(spark, folder):
    return panels.sessions_stitched(stitched(spark, folder), datetime(2024, 1, 31, 1), 480)


@query(
    "alert_states",
    """WITH history AS (
        SELECT event_type AS rule, CAST(user_id % 10 AS VARCHAR) AS label,
            date_trunc('hour', ts) AS evaluated_at, max(value) > 60 AS breach
        FROM events GROUP BY ALL
    ),
    marked AS (
        SELECT *, lag(evaluated_at) OVER w AS prev, lag(breach) OVER w AS broke FROM history
        WINDOW w AS (PARTITION BY rule, label ORDER BY evaluated_at)
    ),
    opened AS (
        SELECT *, max(CASE WHEN breach AND (prev IS NULL OR NOT broke
                OR evaluated_at > prev + INTERVAL 14400 SECOND) THEN evaluated_at END)
            OVER (PARTITION BY rule, label ORDER BY evaluated_at) AS since
        FROM marked
    )
    SELECT rule, label, evaluated_at, breach, CASE WHEN NOT breach THEN 'normal'
        WHEN evaluated_at >= since + INTERVAL 10800 SECOND THEN 'firing' ELSE 'pending' END AS state
    FROM opened""",
)
def alert_states(spark, folder):
    ev = v.table(spark, folder, "events")
    history = ev.groupBy(
        F.col("event_type").alias("rule"),
        (F.col("user_id") % 10).cast("string").alias("label"),
        F.date_trunc("hour", "ts").alias("evaluated_at"),
    ).agg((F.max("value") > 60).alias("breach"))
    return alerts.alert_states(history, ["rule", "label"], 10_800, 14_400)


TICK = timedelta(hours=4)


@query(
    "alert_ticks",
    """WITH seen AS (
        SELECT event_type AS rule, user_id, hour(ts) // 4 AS k, max(value) > 60 AS breach
        FROM events GROUP BY ALL
    ),
    grid AS (
        SELECT p.rule, p.user_id, t.k, coalesce(s.breach, false) AS breach
        FROM (SELECT DISTINCT rule, user_id FROM seen) p CROSS JOIN range(6) t(k)
            LEFT JOIN seen s ON s.rule = p.rule AND s.user_id IS NOT DISTINCT FROM p.user_id AND s.k = t.k
    ),
    runs AS (
        SELECT *, k - max(CASE WHEN NOT breach THEN k ELSE -1 END) OVER (
            PARTITION BY rule, user_id ORDER BY k) AS n
        FROM grid
    ),
    states AS (
        SELECT *, CASE n WHEN 0 THEN 'normal' WHEN 1 THEN 'pending' WHEN 2 THEN 'pending'
            ELSE 'firing' END AS state
        FROM runs
    ),
    steps AS (
        SELECT *, coalesce(lag(state) OVER (PARTITION BY rule, user_id ORDER BY k), 'normal') AS previous
        FROM states
    )
    SELECT rule, CAST(user_id AS VARCHAR) AS labels, state, previous,
        CASE WHEN n > 0 THEN TIMESTAMP '2024-01-31' + INTERVAL 4 HOUR * (k - n + 1) END AS since,
        TIMESTAMP '2024-01-31' + INTERVAL 4 HOUR * k AS evaluated_at
    FROM steps WHERE state <> 'normal' OR previous <> 'normal'""",
)
def alert_ticks(spark, folder):
    """Six ticks, each of which starts from the state the one before has left. A tick sees the
    events of its hours of the day."""
    ev = v.table(spark, folder, "events")
    seen = ev.groupBy(
        F.col("event_type").alias("rule"), F.col("user_id").cast("string").alias("labels"),
        F.floor(F.hour("ts") / 4).alias("k"),
    ).agg(F.max("value").alias("value")).withColumns({
        "severity": F.lit("warning"), "hold_s": F.lit(2 * 14_400), "breach": F.col("value") > 60})
    before, made = spark.createDataFrame([], schemas.ALERTS), []
    for k in range(6):
        now = datetime(2024, 1, 31) + k * TICK
        made.append(alerts.advance(seen.filter(F.col("k") == k).drop("k"), before, now, 14_400))
        before = made[-1].filter("state <> 'normal'")
    return reduce(DataFrame.unionByName, made).drop("severity", "value")


# --- faults -------------------------------------------------------------------------

FAULTS_NOW = datetime(2024, 1, 31)
INCIDENT_SQL = f"""{v.FAULT_SQL},
    latest AS (
        SELECT * FROM fault_events e WHERE NOT EXISTS (
            SELECT 1 FROM fault_events n
            WHERE n.fault_id = e.fault_id AND n.state = e.state AND n.event_at > e.event_at)
    ),
    closings AS (
        SELECT e.fault_id, e.event_at AS over_at FROM latest e JOIN latest b USING (fault_id)
        WHERE e.state = 'ended' AND b.state = 'started' AND e.event_at >= b.event_at
    ),
    incidents AS (
        SELECT fault_id, event_at AS started_at, target_type || ':' || target_id AS target,
            target_id, target_type, kind, source, label,
            coalesce(over_at, least(end_at, TIMESTAMP '2024-01-31')) AS ended_at,
            over_at IS NULL AND end_at > TIMESTAMP '2024-01-31' AS ongoing
        FROM latest LEFT JOIN closings USING (fault_id) WHERE state = 'started'
    )
"""


def fault_incidents(spark, folder: str) -> DataFrame:
    return incidents(v.fault_events(spark, folder), FAULTS_NOW)


@query(
    "dedup_latest",
    f"WITH {INCIDENT_SQL} SELECT fault_id, state, event_at, kind, event_id FROM latest",
)
def dedup_latest(spark, folder):
    rows = v.fault_events(spark, folder).select("fault_id", "state", "event_at", "kind", "event_id")
    return latest_per_key(rows, ["fault_id", "state"], ["event_at"])


@query(
    "incidents",
    f"""WITH {INCIDENT_SQL}
    SELECT fault_id, kind, target, target_type, label, source, started_at, ended_at, ongoing
    FROM incidents""",
)
def all_incidents(spark, folder):
    return fault_incidents(spark, folder)


@query(
    "incidents_overlap",
    f"""WITH {INCIDENT_SQL}
    SELECT started_at AS "time", CASE WHEN ongoing THEN TIMESTAMP '2024-01-31' ELSE ended_at END
        AS time_end, label AS text, kind AS tags
    FROM incidents WHERE started_at <= TIMESTAMP '2024-01-29'
        AND (ongoing OR ended_at >= TIMESTAMP '2024-01-25')""",
)
def incidents_overlap(spark, folder):
    found = fault_incidents(spark, folder)
    return annotations(found, datetime(2024, 1, 25), datetime(2024, 1, 29), FAULTS_NOW)


@query(
    "incidents_recent",
    f"""WITH {INCIDENT_SQL}
    SELECT started_at, CASE WHEN NOT ongoing THEN ended_at END AS ended_at, kind, target, label,
        source, fault_id
    FROM incidents WHERE started_at >= TIMESTAMP '2023-12-31'
    ORDER BY started_at DESC, fault_id LIMIT 20""",
)
def incidents_recent(spark, folder):
    return recent(fault_incidents(spark, folder), EVENTS_START)


@query(
    "fault_rules",
    f"""WITH {v.FAULT_SQL}
    SELECT event_id, CASE
        WHEN kind = 'down' AND target_type <> 'circuit' THEN 'down needs a circuit'
        WHEN kind = 'slow' AND target_type NOT IN ('server', 'app') THEN 'slow needs a server or app'
        WHEN kind = 'degrade' AND target_type IN ('server', 'app')
            THEN 'degrade needs a network element'
        WHEN latency_ms NOT BETWEEN 0 AND 10000 THEN 'latency_ms out of range'
        WHEN loss < 0 OR loss >= 0.5 THEN 'loss out of range'
        WHEN server_factor NOT BETWEEN 1 AND 100 THEN 'server_factor out of range'
        ELSE 'ok' END AS verdict
    FROM fault_events""",
)
def fault_rules(spark, folder):
    rows = v.fault_events(spark, folder)
    verdict = F.coalesce(wire.fault_rule_error(), F.lit("ok"))
    return rows.select("event_id", verdict.alias("verdict"))


# Every event crosses three elements; errors are the degraded ones.
CROSSED_SQL = """
    crossed AS (
        SELECT epoch_us(ts) // 1000000 // 21600 AS period, el.t AS element_type, el.i AS element_id,
            event_type = 'error' AS degraded
        FROM events, LATERAL (VALUES ('app', CAST(user_id % 25 AS VARCHAR)),
            ('switch', CAST(user_id % 5 AS VARCHAR)), ('circuit', CAST(user_id % 25 AS VARCHAR)))
            AS el(t, i)
    ),
    per_element AS (
        SELECT period, element_type, element_id, count(*) AS n, count_if(degraded) AS d
        FROM crossed GROUP BY ALL
    ),
    totals AS (
        SELECT period, sum(d) AS total FROM per_element WHERE element_type = 'app' GROUP BY period
    ),
    rated AS (
        SELECT p.*, round_even(d / n * 1e3, 0) / 1e3 AS prec,
            round_even(CASE WHEN total > 0 THEN d / total END * 1e3, 0) / 1e3 AS cover
        FROM per_element p JOIN totals USING (period) WHERE d >= 1
    ),
    scored AS (
        SELECT *, round_even(2 * prec * cover / (prec + cover) * 1e3, 0) / 1e3 AS score FROM rated
    ),
    best AS (
        SELECT * FROM scored QUALIFY score = max(score) OVER (PARTITION BY period)
    )
"""


@query(
    "localisation_hit_rate",
    f"""WITH {INCIDENT_SQL}, {CROSSED_SQL},
    hits AS (
        SELECT DISTINCT i.fault_id FROM incidents i JOIN best b
            ON b.element_type = i.target_type AND b.element_id = i.target_id
            AND b.period BETWEEN epoch_us(i.started_at) // 1000000 // 21600
                AND epoch_us(i.ended_at) // 1000000 // 21600
    )
    SELECT count(*) AS incidents, (SELECT count(*) FROM hits) AS hits,
        round_even((SELECT count(*) FROM hits) / count(*) * 1e4, 0) / 1e4 AS hit_rate
    FROM incidents""",
)
def localisation_hit_rate(spark, folder):
    ev = v.table(spark, folder, "events")
    user = F.col("user_id")
    kinds = (("app", user % 25), ("switch", user % 5), ("circuit", user % 25))
    steps = F.array(
        *[
            F.struct(F.lit(t).alias("element_type"), i.cast("string").alias("element_id"))
            for t, i in kinds
        ]
    )
    rows = (
        ev.select(
            F.date_trunc("minute", "ts").alias("minute"),
            (F.col("event_type") == "error").cast("bigint").alias("degraded"),
            F.inline(steps),
        )
        .groupBy("minute", "element_type", "element_id")
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("degraded").alias("degraded"))
    )
    found = fault_incidents(spark, folder).withColumn(
        "target_id", F.split_part("target", F.lit(":"), F.lit(2))
    )
    return hit_rate(found, best_by_period(rows, 21_600, 1), 21_600)


