"""The given tables read as the library's own: half-flows from `events`, sessions from the
order tables, an inventory from the small tables. Every row of the tables is read; only the SLA
targets of the estate name some applications and not others, so that defaults are met too.

Each view exists twice, as a DataFrame and as SQL for the oracle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import small
from ..settings import StitchSettings
from ..session import configure
from ..sources.inventory import Lookups


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; times are declared UTC timestamps when read, so that a filter on them
    still reaches the file (a cast would stop it)."""
    path = f"{folder}/{name}.parquet"
    found = configure(spark).read.parquet(path).schema
    declared = T.StructType(
        [T.StructField(f.name, T.TimestampType() if _is_time(f) else f.dataType) for f in found]
    )
    return spark.read.schema(declared).parquet(path)


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# --- half-flows ---------------------------------------------------------------------

# A user's events of one day are one session; clicks, views and errors travel one way,
# purchases and signups the other. Error events take a place in the numbering but are
# refused at ingest, so they leave gaps. Views are delivered twice.
HALFFLOW_SQL = """
    ev AS (
        SELECT *, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day,
            CASE WHEN event_type IN ('click', 'view', 'error') THEN 'c2s' ELSE 's2c' END AS side
        FROM events
    ),
    numbered AS (
        SELECT *, min(ts) OVER (PARTITION BY user_id, day, side) AS first_seen,
            row_number() OVER (PARTITION BY user_id, day, side ORDER BY ts, event_id) - 1
                AS record_seq,
            row_number() OVER (PARTITION BY user_id, day, side ORDER BY ts DESC, event_id DESC) = 1
                AS is_final,
            epoch_us(day) + (user_id % 50) * 100000 AS base_us
        FROM ev
    ),
    exported AS (
        SELECT lpad(CAST(event_id AS VARCHAR), 16, '0') AS record_id,
            'u' || CAST(user_id AS VARCHAR) AS community_id, first_seen,
            CASE WHEN event_type = 'error' THEN 'error' ELSE side END AS direction,
            CAST(record_seq AS INTEGER) AS record_seq, is_final,
            'GW-' || CAST(event_id % 3 AS VARCHAR) AS probe_id,
            ts AS exported_at, first_seen AS flow_start, ts AS flow_end,
            '10.' || CAST(user_id // 65536 AS VARCHAR) || '.' || CAST(user_id // 256 % 256 AS VARCHAR)
                || '.' || CAST(user_id % 256 AS VARCHAR) AS src_ip,
            '10.200.0.' || CAST(user_id % 200 AS VARCHAR) AS dst_ip,
            CAST(1024 + user_id % 50000 AS INTEGER) AS src_port, 443 AS dst_port,
            CASE WHEN user_id % 10 = 0 THEN 17 ELSE 6 END AS ip_proto,
            user_id % 100 AS tunnel_id, 'app-' || CAST(user_id % 9 AS VARCHAR) AS app,
            'cat-' || CAST(user_id % 3 AS VARCHAR) AS app_category, 'TLS' AS l7_proto,
            CAST(round(value * 100) AS BIGINT) AS bytes, event_id % 40 + 1 AS packets,
            CASE WHEN event_id % 7 = 0 THEN event_id % 3 ELSE 0 END AS retrans_packets,
            CASE WHEN side = 'c2s' THEN base_us END AS syn_at,
            CASE WHEN side = 's2c' THEN base_us + 10000 + (event_id % 30) * 1000 END AS synack_at,
            CASE WHEN side = 'c2s' THEN base_us + 20000 + (event_id % 100) * 1000 END AS ack_at,
            CASE WHEN side = 'c2s' THEN base_us + 21000 + (event_id % 100) * 1000 END AS req_at,
            CASE WHEN side = 's2c' THEN base_us + 150000 + (event_id % 1500) * 1000 END AS resp_at,
            ts + to_seconds(event_id % 600) AS ingested_at, event_type, event_id
        FROM numbered
    ),
    delivered AS (
        SELECT * FROM exported
        UNION ALL
        SELECT * REPLACE (ingested_at + INTERVAL 30 SECOND AS ingested_at)
        FROM exported WHERE event_type = 'view'
    ),
    hf AS (SELECT * FROM delivered WHERE direction <> 'error')
"""


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that arrives, replays and refusable records included."""
    ev = table(spark, folder, "events").withColumns(
        {
            "day": F.date_trunc("day", "ts"),
            "side": F.when(F.col("event_type").isin("click", "view", "error"), "c2s").otherwise("s2c"),
        }
    )
    half = W.partitionBy("user_id", "day", "side")
    user, event = F.col("user_id"), F.col("event_id")
    base = F.unix_micros("day") + (user % 50) * 100_000
    out_way, back_way = F.col("side") == "c2s", F.col("side") == "s2c"

    position = F.row_number().over(half.orderBy("ts", "event_id"))

    def seen(way: Column, us: Column) -> Column:
        return F.timestamp_micros(F.when(way, us))

    exported = ev.select(
        F.lpad(event.cast("string"), 16, "0").alias("record_id"),
        text("u", user).alias("community_id"),
        F.min("ts").over(half).alias("first_seen"),
        F.when(F.col("event_type") == "error", "error").otherwise(F.col("side")).alias("direction"),
        (position - 1).alias("record_seq"),
        (position == F.count(F.lit(1)).over(half)).alias("is_final"),
        text("GW-", event % 3).alias("probe_id"),
        F.col("ts").alias("exported_at"),
        F.min("ts").over(half).alias("flow_start"),
        F.col("ts").alias("flow_end"),
        text("10.", F.floor(user / 65536), ".", F.floor(user / 256) % 256, ".", user % 256).alias("src_ip"),
        text("10.200.0.", user % 200).alias("dst_ip"),
        (1024 + user % 50000).cast("int").alias("src_port"),
        F.lit(443).alias("dst_port"),
        F.when(user % 10 == 0, 17).otherwise(6).alias("ip_proto"),
        (user % 100).alias("tunnel_id"),
        text("app-", user % 9).alias("app"),
        text("cat-", user % 3).alias("app_category"),
        F.lit("TLS").alias("l7_proto"),
        F.round(F.col("value") * 100).cast("bigint").alias("bytes"),
        (event % 40 + 1).alias("packets"),
        F.when(event % 7 == 0, event % 3).otherwise(0).alias("retrans_packets"),
        seen(out_way, base).alias("tcp_syn"),
        seen(back_way, base + 10_000 + (event % 30) * 1000).alias("tcp_synack"),
        seen(out_way, base + 20_000 + (event % 100) * 1000).alias("tcp_ack"),
        seen(out_way, base + 21_000 + (event % 100) * 1000).alias("first_req"),
        seen(back_way, base + 150_000 + (event % 1500) * 1000).alias("first_resp"),
        F.timestamp_micros(F.unix_micros("ts") + (event % 600) * 1_000_000).alias("ingested_at"),
        "event_type",
        "event_id",
    )
    copies = F.when(F.col("event_type") == "view", F.array(F.lit(0), F.lit(30)))
    delay = F.explode(copies.otherwise(F.array(F.lit(0)))).alias("delay_s")
    return exported.select("*", delay).withColumn(
        "ingested_at", F.timestamp_micros(F.unix_micros("ingested_at") + F.col("delay_s") * 1_000_000)
    ).drop("delay_s")


def halfflows(spark: SparkSession, folder: str) -> DataFrame:
    return delivered(spark, folder).filter(F.col("direction") != "error")


# The pairing limits that suit sessions of a day.
FLOW_SETTINGS = StitchSettings(
    pair_tolerance_ms=43_200_000, probe_skew_ms=7_200_000, lookback_s=60 * 86_400
)
FLOW_LO, FLOW_HI = datetime(2023, 12, 1), datetime(2024, 1, 30, 23, 59)
FLOW_NOW = datetime(2024, 1, 31)

# Halves and their answers, for every query on stitched flows. The oracles are formulated
# apart from the plans: a range join finds the answer, and whole rows are picked by arg_min.
# Numbers such as 4e-1 make DuckDB calculate in doubles.


def paired_sql(arrivals: str = "hf") -> str:
    return f"""{HALFFLOW_SQL},
    genuine AS (
        SELECT unnest(copy) FROM (
            SELECT arg_min(r, r.ingested_at) AS copy FROM (SELECT * FROM {arrivals}) r
            GROUP BY r.record_id)
    ),
    openings AS (
        SELECT community_id, first_seen, direction, max(syn_at) AS syn_us, max(synack_at) AS synack_us,
            max(ack_at) AS ack_us, max(req_at) AS req_us, max(resp_at) AS resp_us
        FROM genuine WHERE record_seq = 0 GROUP BY ALL
    ),
    totals AS (
        SELECT direction, first_seen, community_id, count(*) AS n_records,
            {", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for c, n in SUMMED)},
            {", ".join(f"min({c}) AS {c}" for c in DESCRIBED)},
            max(flow_end) AS last_seen, max(ingested_at) AS last_ingest,
            count_if(is_final) > 0 AND len(list_distinct(list(record_seq))) - 1 = max(record_seq) AS whole
        FROM genuine GROUP BY ALL
    ),
    halves AS (
        SELECT totals.*, {", ".join(f"coalesce({t}, 0) AS {t}" for t in STAMPS)}
        FROM totals LEFT JOIN openings USING (community_id, first_seen, direction)
    ),
    answered AS (
        SELECT q.community_id, q.first_seen, min(a.first_seen) AS answer
        FROM totals q JOIN totals a USING (community_id)
        WHERE q.direction = 'c2s' AND a.direction = 's2c'
            AND a.first_seen + INTERVAL 7200 SECOND >= q.first_seen
        GROUP BY ALL
    ),
    paired AS (
        SELECT q.* EXCLUDE (direction), a.direction IS NOT NULL AS matched,
            coalesce(a.whole, FALSE) AS s_whole, coalesce(a.probe_id, '') AS s_probe,
            {", ".join(f"coalesce(a.{c}, 0) AS s_{c}" for c in ("bytes", "packets", "retrans", "synack_us", "resp_us"))},
            coalesce(a.n_records, 0) AS s_records, coalesce(a.last_seen, q.last_seen) AS s_last_seen,
            coalesce(a.last_ingest, q.last_ingest) AS s_last_ingest
        FROM (SELECT * FROM halves WHERE direction = 'c2s') q
        LEFT JOIN answered USING (community_id, first_seen)
        LEFT JOIN (SELECT * FROM halves WHERE direction = 's2c') a
            ON a.community_id = q.community_id AND a.first_seen = answer
            AND date_diff('hour', q.first_seen, a.first_seen) BETWEEN -13 AND 13
            AND abs(epoch_ms(a.first_seen) - epoch_ms(q.first_seen)) <= 43200000
    )
"""


SUMMED = (("bytes", "bytes"), ("packets", "packets"), ("retrans_packets", "retrans"))
DESCRIBED = ("app", "app_category", "l7_proto", "ip_proto", "probe_id", "tunnel_id",
             "src_ip", "src_port", "dst_ip", "dst_port")
STAMPS = ("syn_us", "synack_us", "ack_us", "req_us", "resp_us")
PAIRED_SQL = paired_sql()


# --- inventory ----------------------------------------------------------------------

INVENTORY_SQL = """
    inv_branches AS (
        SELECT n_name AS branch_id, r_name AS region,
            CASE WHEN r_regionkey < 2 THEN 'large' ELSE 'small' END AS size,
            'R-' || CAST(n_nationkey AS VARCHAR) AS router_id,
            r_name AS primary_provider, 'S-' || CAST(n_nationkey AS VARCHAR) AS primary_circuit_id
        FROM nation JOIN region ON r_regionkey = n_regionkey
    ),
    inv_prefixes AS (
        SELECT '10.0.0.' || CAST(8 * n_nationkey AS VARCHAR) || '/29' AS prefix, n_name AS branch_id,
            CASE WHEN n_nationkey % 2 = 0 THEN 'lan' ELSE 'guest' END AS segment,
            167772160 + 8 * n_nationkey AS net, 29 AS len FROM nation
        UNION ALL
        SELECT '10.0.' || CAST(r_regionkey AS VARCHAR) || '.0/24', r_name, 'guest',
            167772160 + 256 * r_regionkey, 24 FROM region
        UNION ALL
        SELECT '10.' || CAST(r_regionkey AS VARCHAR) || '.0.0/16', r_name, 'lan',
            167772160 + 65536 * r_regionkey, 16 FROM region
    ),
    inv_devices AS (
        SELECT 167772160 + 3 * c_custkey AS ip_num, c_name AS device_id,
            c_mktsegment AS device_type, n_name AS branch_id,
            n_name || '-SW' || CAST(c_custkey % 3 + 1 AS VARCHAR) AS switch_id
        FROM customer JOIN nation ON n_nationkey = c_nationkey
    ),
    inv_servers AS (
        SELECT 180879360 + s_suppkey AS ip_num, s_name AS server_id,
            'app-' || CAST(s_suppkey % 9 AS VARCHAR) AS app,
            'dc-' || CAST(s_suppkey % 2 AS VARCHAR) AS dc
        FROM supplier
    ),
    inv_circuits AS (
        SELECT s_suppkey AS tunnel_id, 'S-' || CAST(s_suppkey AS VARCHAR) AS circuit_id,
            n_name AS branch_id, r_name AS provider, r_name || ' Telecom' AS provider_name,
            n_name AS pop_id,
            CASE WHEN s_suppkey % 4 = 3 THEN 'backup' ELSE 'primary' END AS role,
            100 AS bandwidth_mbps
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
        JOIN region ON r_regionkey = n_regionkey
    ),
    inv_apps AS (
        SELECT 'app-' || CAST(r_regionkey AS VARCHAR) AS name, 'cat' AS category,
            CASE WHEN r_regionkey < 2 THEN 'critical' ELSE 'business' END AS criticality,
            CAST(100 + 50 * r_regionkey AS DOUBLE) AS response_good_ms,
            CAST(900 + 100 * r_regionkey AS DOUBLE) AS response_bad_ms,
            CAST(20 AS DOUBLE) AS rtt_good_ms, CAST(60 + 5 * r_regionkey AS DOUBLE) AS rtt_bad_ms,
            CAST(0.5 AS DOUBLE) AS retrans_good_pct,
            CAST(2 + r_regionkey AS DOUBLE) AS retrans_bad_pct
        FROM region
    )
"""


def inventory(spark: SparkSession, folder: str) -> Lookups:
    region, nation = (table(spark, folder, t) for t in ("region", "nation"))
    supplier, customer = (table(spark, folder, t) for t in ("supplier", "customer"))
    located = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    k, r, s, c = (F.col(x) for x in ("n_nationkey", "r_regionkey", "s_suppkey", "c_custkey"))
    branches = located.select(
        F.col("n_name").alias("branch_id"),
        F.col("r_name").alias("region"),
        F.when(r < 2, "large").otherwise("small").alias("size"),
        text("R-", k).alias("router_id"),
        F.col("r_name").alias("primary_provider"),
        text("S-", k).alias("primary_circuit_id"),
    )
    prefixes = (
        nation.select(
            text("10.0.0.", 8 * k, "/29").alias("prefix"),
            F.col("n_name").alias("branch_id"),
            F.when(k % 2 == 0, "lan").otherwise("guest").alias("segment"),
        )
        .unionByName(
            region.select(
                text("10.0.", r, ".0/24").alias("prefix"),
                F.col("r_name").alias("branch_id"),
                F.lit("guest").alias("segment"),
            )
        )
        .unionByName(
            region.select(
                text("10.", r, ".0.0/16").alias("prefix"),
                F.col("r_name").alias("branch_id"),
                F.lit("lan").alias("segment"),
            )
        )
    )
    devices = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        (F.lit(167_772_160) + 3 * c).alias("ip_num"),
        F.col("c_name").alias("device_id"),
        F.col("c_mktsegment").alias("device_type"),
        F.col("n_name").alias("branch_id"),
        text(F.col("n_name"), "-SW", c % 3 + 1).alias("switch_id"),
    )
    servers = supplier.select(
        (F.lit(180_879_360) + s).alias("ip_num"),
        F.col("s_name").alias("server_id"),
        text("app-", s % 9).alias("app"),
        text("dc-", s % 2).alias("dc"),
    )
    circuits = supplier.join(located, F.col("n_nationkey") == F.col("s_nationkey")).select(
        s.alias("tunnel_id"),
        text("S-", s).alias("circuit_id"),
        F.col("n_name").alias("branch_id"),
        F.col("r_name").alias("provider"),
        text(F.col("r_name"), " Telecom").alias("provider_name"),
        F.col("n_name").alias("pop_id"),
        F.when(s % 4 == 3, "backup").otherwise("primary").alias("role"),
        F.lit(100).alias("bandwidth_mbps"),
    )
    apps = region.select(
        text("app-", r).alias("name"),
        F.lit("cat").alias("category"),
        F.when(r < 2, "critical").otherwise("business").alias("criticality"),
        (100 + 50 * r).cast("double").alias("response_good_ms"),
        (900 + 100 * r).cast("double").alias("response_bad_ms"),
        F.lit(20.0).alias("rtt_good_ms"),
        (60 + 5 * r).cast("double").alias("rtt_bad_ms"),
        F.lit(0.5).alias("retrans_good_pct"),
        (2 + r).cast("double").alias("retrans_bad_pct"),
    )
    return Lookups(devices, prefixes, circuits, branches, servers, apps)


# --- sessions -----------------------------------------------------------------------

# One session per order line. The rollups' "minute" is the month of shipping, so that a
# branch has several sessions in each.
SESSION_SQL = """
    sess AS (
        SELECT CAST(date_trunc('month', l.l_shipdate) AS TIMESTAMP) AS session_start,
            CAST(date_trunc('month', l.l_shipdate) AS TIMESTAMP) AS minute,
            CAST(l.l_shipdate AS TIMESTAMP) AS shipped,
            'o' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)
                AS community_id,
            cn.n_name AS branch_id, cr.r_name AS region, sn.n_name AS pop_id, sr.r_name AS provider,
            'S-' || CAST(l.l_suppkey AS VARCHAR) AS circuit_id,
            CASE WHEN l.l_linenumber <= 5 THEN 'primary' ELSE 'backup' END AS circuit_role,
            cn.n_name || '-SW' || CAST(o.o_custkey % 3 + 1 AS VARCHAR) AS switch_id,
            'R-' || CAST(cn.n_nationkey AS VARCHAR) AS router_id,
            'GW-' || CAST(l.l_linenumber % 3 AS VARCHAR) AS probe_c2s,
            'GW-' || CAST(o.o_orderkey % 3 AS VARCHAR) AS probe_s2c,
            CASE WHEN p.p_size <= 10 THEN '' ELSE 'SRV-' || CAST(p.p_size AS VARCHAR) END
                AS server_id,
            p.p_brand AS app, c.c_mktsegment AS criticality, c.c_name AS device_id,
            l.l_returnflag = 'R' AND l.l_quantity > 25 AS degraded,
            l.l_discount >= 0.08 AS net_degraded,
            CAST(l.l_quantity AS BIGINT) AS bytes_c2s, CAST(l.l_quantity AS BIGINT) * 2 AS bytes_s2c,
            CAST(l.l_quantity AS BIGINT) * 10 AS packets_c2s, CAST(l.l_linenumber AS BIGINT) AS packets_s2c,
            CAST(l.l_linenumber AS BIGINT) AS retrans_c2s, CAST(0 AS BIGINT) AS retrans_s2c,
            CAST(o.o_orderkey % 101 AS INTEGER) AS quality, l.l_extendedprice AS response_ms,
            CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity END AS client_rtt_ms
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation cn ON cn.n_nationkey = c.c_nationkey
        JOIN region cr ON cr.r_regionkey = cn.n_regionkey
        JOIN supplier s ON s.s_suppkey = l.l_suppkey
        JOIN nation sn ON sn.n_nationkey = s.s_nationkey
        JOIN region sr ON sr.r_regionkey = sn.n_regionkey
        JOIN part p ON p.p_partkey = l.l_partkey
    )
"""


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Lines move twice, by part and by order, with nothing but what a query asks of them; what
    a line says alone is computed before. Names of places are looked up at the end.

    The join by order is a merge at every size: the estimate of a join is the product of its
    sides, so what Catalyst would choose for the orders hangs on which stage ends first.
    """
    region, nation = (table(spark, folder, t) for t in ("region", "nation"))
    located = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    located = small(located.select("n_nationkey", "n_name", "r_name"))

    def place(prefix: str) -> DataFrame:
        return located.toDF(prefix + "key", prefix + "nation", prefix + "region")

    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    )
    supplier = small(table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"))
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size")
    orders = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey")
        .join(customer, F.col("c_custkey") == F.col("o_custkey"))
    )
    quantity, line = F.col("l_quantity").cast("bigint"), F.col("l_linenumber")
    lines = (
        table(spark, folder, "lineitem")
        .select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            line,
            F.date_trunc("month", "l_shipdate").alias("month"),
            "l_shipdate",
            ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)).alias("degraded"),
            (F.col("l_discount") >= 0.08).alias("net_degraded"),
            quantity.alias("quantity"),
            "l_extendedprice",
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("client_rtt_ms"),
        )
        .join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(part, F.col("p_partkey") == F.col("l_partkey"))
        .join(orders.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(place("c_"), F.col("c_nationkey") == F.col("c_key"))
        .join(place("s_"), F.col("s_nationkey") == F.col("s_key"))
    )
    quantity = F.col("quantity")
    return lines.select(
        F.col("month").alias("session_start"),
        F.col("month").alias("minute"),
        F.col("l_shipdate").alias("shipped"),
        text("o", F.col("l_orderkey"), "-", line).alias("community_id"),
        F.col("c_nation").alias("branch_id"),
        F.col("c_region").alias("region"),
        F.col("s_nation").alias("pop_id"),
        F.col("s_region").alias("provider"),
        text("S-", F.col("l_suppkey")).alias("circuit_id"),
        F.when(line <= 5, "primary").otherwise("backup").alias("circuit_role"),
        text(F.col("c_nation"), "-SW", F.col("o_custkey") % 3 + 1).alias("switch_id"),
        text("R-", F.col("c_key")).alias("router_id"),
        text("GW-", line % 3).alias("probe_c2s"),
        text("GW-", F.col("o_orderkey") % 3).alias("probe_s2c"),
        F.when(F.col("p_size") <= 10, "").otherwise(text("SRV-", F.col("p_size"))).alias("server_id"),
        F.col("p_brand").alias("app"),
        F.col("c_mktsegment").alias("criticality"),
        F.col("c_name").alias("device_id"),
        "degraded",
        "net_degraded",
        quantity.alias("bytes_c2s"),
        (quantity * 2).alias("bytes_s2c"),
        (quantity * 10).alias("packets_c2s"),
        line.cast("bigint").alias("packets_s2c"),
        line.cast("bigint").alias("retrans_c2s"),
        F.lit(0).cast("bigint").alias("retrans_s2c"),
        (F.col("o_orderkey") % 101).cast("int").alias("quality"),
        F.col("l_extendedprice").alias("response_ms"),
        "client_rtt_ms",
    )


# The last month is the one still being filled; a window of this many minutes reaches
# back past the first month.
SESSION_NOW = datetime(2001, 11, 1, 0, 0, 30)
RANGE = (datetime(1994, 1, 1), datetime(2002, 1, 1))
ALL_MINUTES = 4_500_000
NOW_SQL = "TIMESTAMP '2001-11-01'"


# --- fault events -------------------------------------------------------------------

# A signup starts a fault of that user on the element its properties name, a purchase
# ends it.
FAULT_SQL = """
    fault_events AS (
        SELECT 'f' || CAST(user_id AS VARCHAR) AS fault_id,
            CASE WHEN event_type IN ('purchase', 'click') THEN 'ended' ELSE 'started' END AS state,
            ts AS event_at,
            CASE WHEN event_id % 4 = 0 THEN 'slow' WHEN event_id % 4 = 3 THEN 'down'
                 ELSE 'degrade' END AS kind,
            CASE WHEN event_id % 4 = 0 THEN 'app' WHEN event_id % 3 = 0 THEN 'switch'
                 ELSE 'circuit' END AS target_type,
            CAST(user_id % 25 AS VARCHAR) AS target_id,
            'fault of ' || CAST(user_id AS VARCHAR) AS label, 'schedule' AS source,
            ts AS start_at, ts + INTERVAL 3 DAY AS end_at,
            value * 30 AS latency_ms, value / 400 AS loss, 1 + value / 2 AS server_factor, event_id
        FROM events
    )
"""


def fault_events(spark: SparkSession, folder: str) -> DataFrame:
    ev = table(spark, folder, "events")
    user, event = F.col("user_id"), F.col("event_id")
    kind = F.when(event % 4 == 0, "slow").when(event % 4 == 3, "down").otherwise("degrade")
    target_type = F.when(event % 4 == 0, "app").when(event % 3 == 0, "switch").otherwise("circuit")
    return ev.select(
        text("f", user).alias("fault_id"),
        F.when(F.col("event_type").isin("purchase", "click"), "ended").otherwise("started").alias("state"),
        F.col("ts").alias("event_at"),
        kind.alias("kind"),
        text(target_type, ":", user % 25).alias("target"),
        target_type.alias("target_type"),
        (user % 25).cast("string").alias("target_id"),
        text("fault of ", user).alias("label"),
        F.lit("schedule").alias("source"),
        F.col("ts").alias("start_at"),
        (F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("end_at"),
        (F.col("value") * 30).alias("latency_ms"),
        (F.col("value") / 400).alias("loss"),
        (1 + F.col("value") / 2).alias("server_factor"),
        "event_id",
    )
