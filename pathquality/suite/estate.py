"""Queries over the inventory: nine tables derived from the given ones, their views, lookups
and integrity rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from ..session import scratch_folder
from ..sources import inventory as inv
from ..sources import schemas
from . import views as v
from .registry import query

TABLES_SQL = """
    place AS (
        SELECT n_nationkey, n_name, r_regionkey, r_name
        FROM nation JOIN region ON r_regionkey = n_regionkey
    ),
    providers AS (
        SELECT r_name AS code, r_name || ' Telecom' AS name, r_regionkey AS latency_factor FROM region
    ),
    pops AS (
        SELECT n_name AS pop_id, r_name AS provider, n_name AS region, n_nationkey AS backbone_ms
        FROM place
    ),
    branches AS (
        SELECT 'B-' || CAST(c_custkey AS VARCHAR) AS branch_id, CAST(c_custkey AS INTEGER) AS "index",
            c_mktsegment AS region, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'huge' ELSE 'small' END
                AS size,
            '10.' || CAST(c_custkey // 256 % 256 AS VARCHAR) || '.' || CAST(c_custkey % 256 AS VARCHAR)
                || '.0/24' AS lan_prefix,
            '100.' || CAST(c_custkey // 256 % 256 AS VARCHAR) || '.' || CAST(c_custkey % 256 AS VARCHAR)
                || '.0/24' AS guest_prefix,
            'R-' || CAST(c_custkey AS VARCHAR) AS router_id,
            'B-' || CAST(c_custkey AS VARCHAR) || '-SW1|B-' || CAST(c_custkey AS VARCHAR) || '-SW2'
                AS switch_ids,
            'C-' || CAST(2 * c_custkey AS VARCHAR) AS primary_circuit_id,
            'C-' || CAST(2 * c_custkey + 1 AS VARCHAR) AS backup_circuit_id
        FROM customer
    ),
    circuits AS (
        SELECT 'C-' || CAST(2 * c_custkey + k AS VARCHAR) AS circuit_id,
            2 * c_custkey + CASE WHEN c_mktsegment = 'FURNITURE' THEN 0 ELSE k END AS tunnel_id,
            'B-' || CAST(c_custkey AS VARCHAR) AS branch_id, r_name AS provider, n_name AS pop_id,
            CASE WHEN k = 0 THEN 'primary' ELSE 'backup' END AS role, 100 AS bandwidth_mbps
        FROM customer JOIN place ON n_nationkey = c_nationkey, (VALUES (0), (1)) AS r(k)
    ),
    devices AS (
        SELECT 'D-' || CAST(o_orderkey AS VARCHAR) AS device_id,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'guest' ELSE o_orderpriority END AS device_type,
            CASE WHEN o_orderstatus = 'P' THEN 'B?' ELSE 'B-' END || CAST(o_custkey AS VARCHAR)
                AS branch_id,
            'B-' || CAST(o_custkey AS VARCHAR) || '-SW1' AS switch_id,
            2885681152 + o_orderkey AS ip_num
        FROM orders
    ),
    servers AS (
        SELECT s_name AS server_id, 'app-' || CAST(s_nationkey AS VARCHAR) AS app,
            'dc-' || CAST(s_nationkey % 2 AS VARCHAR) AS dc, 180879360 + s_suppkey AS ip_num
        FROM supplier
    ),
    apps AS (
        SELECT p_brand AS name, min(p_type) AS category,
            CASE WHEN min(p_size) <= 1 THEN 'critical' ELSE 'bulk' END AS criticality
        FROM part GROUP BY p_brand
    ),
    sla_targets AS (
        SELECT p_brand AS app, 100 AS response_good_ms,
            CASE WHEN p_brand = 'Brand#11' THEN 50 ELSE 900 END AS response_bad_ms
        FROM part WHERE p_brand < 'Brand#2' GROUP BY p_brand
    )
"""


def tables(spark, folder: str) -> dict[str, DataFrame]:
    """Some rows break rules on purpose: sizes, tunnel numbers, device branches, one target."""
    read = lambda name: v.table(spark, folder, name)
    region, customer, orders = read("region"), read("customer"), read("orders")
    place = read("nation").join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    c, s, o = F.col("c_custkey"), F.col("s_suppkey"), F.col("o_orderkey")

    def net(first: int) -> Column:
        return v.text(f"{first}.", F.floor(c / 256) % 256, ".", c % 256, ".0/24")

    made = {
        "providers": region.select(
            F.col("r_name").alias("code"),
            v.text(F.col("r_name"), " Telecom").alias("name"),
            F.col("r_regionkey").alias("latency_factor"),
        ),
        "pops": place.select(
            F.col("n_name").alias("pop_id"),
            F.col("r_name").alias("provider"),
            F.col("n_name").alias("region"),
            F.col("n_nationkey").alias("backbone_ms"),
        ),
        "gateways": region.select(
            v.text("GW-", F.col("r_regionkey")).alias("gateway_id"),
            v.text("dc-", F.col("r_regionkey") % 2).alias("dc"),
        ),
        "branches": customer.select(
            v.text("B-", c).alias("branch_id"),
            c.alias("index"),
            F.col("c_mktsegment").alias("region"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "huge").otherwise("small").alias("size"),
            net(10).alias("lan_prefix"),
            net(100).alias("guest_prefix"),
            v.text("R-", c).alias("router_id"),
            v.text("B-", c, "-SW1|B-", c, "-SW2").alias("switch_ids"),
            v.text("C-", 2 * c).alias("primary_circuit_id"),
            v.text("C-", 2 * c + 1).alias("backup_circuit_id"),
        ),
        "circuits": customer.join(place, F.col("n_nationkey") == F.col("c_nationkey"))
        .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            v.text("C-", 2 * c + F.col("k")).alias("circuit_id"),
            (2 * c + F.when(F.col("c_mktsegment") == "FURNITURE", 0).otherwise(F.col("k"))).alias(
                "tunnel_id"
            ),
            v.text("B-", c).alias("branch_id"),
            F.col("r_name").alias("provider"),
            F.col("n_name").alias("pop_id"),
            F.when(F.col("k") == 0, "primary").otherwise("backup").alias("role"),
            F.lit(100).alias("bandwidth_mbps"),
            F.lit(5).alias("access_ms"),
        ),
        "devices": orders.select(
            v.text("D-", o).alias("device_id"),
            F.when(F.col("o_orderpriority") == "5-LOW", "guest")
            .otherwise(F.col("o_orderpriority"))
            .alias("device_type"),
            v.text(
                F.when(F.col("o_orderstatus") == "P", "B?").otherwise("B-"), F.col("o_custkey")
            ).alias("branch_id"),
            v.text("B-", F.col("o_custkey"), "-SW1").alias("switch_id"),
            v.text("172.", F.floor(o / 65536), ".", F.floor(o / 256) % 256, ".", o % 256).alias("ip"),
        ),
        "servers": read("supplier").select(
            F.col("s_name").alias("server_id"),
            v.text("app-", F.col("s_nationkey")).alias("app"),
            v.text("dc-", F.col("s_nationkey") % 2).alias("dc"),
            v.text("10.200.", F.floor(s / 256), ".", s % 256).alias("ip"),
        ),
        "apps": read("part").groupBy(F.col("p_brand").alias("name")).agg(
            F.min("p_type").alias("category"),
            F.when(F.min("p_size") <= 1, "critical").otherwise("bulk").alias("criticality"),
            F.lit(6).alias("ip_proto"),
            F.lit("TLS").alias("l7"),
            F.lit(443).alias("dst_port"),
            F.lit("dc").alias("hosted"),
        ),
        "sla_targets": read("part").filter(F.col("p_brand") < "Brand#2")
        .groupBy(F.col("p_brand").alias("app")).agg(
            F.lit(100).alias("response_good_ms"),
            F.when(F.col("app") == "Brand#11", 50).otherwise(900).alias("response_bad_ms"),
            F.lit(40).alias("rtt_good_ms"),
            F.lit(70).alias("rtt_bad_ms"),
            F.lit(1).alias("retrans_good_pct"),
            F.lit(2).alias("retrans_bad_pct"),
        ),
    }
    empty = {t: spark.createDataFrame([], ddl).schema for t, ddl in schemas.INVENTORY.items()}
    return {
        t: df.select(*[F.col(f.name).cast(f.dataType) for f in empty[t]]) for t, df in made.items()
    }


WITH = f"WITH {TABLES_SQL}"


@query(
    "inventory_device_by_ip",
    f"""{WITH} SELECT ip_num, device_id, device_type, branch_id, switch_id FROM devices
    WHERE device_type <> 'guest'""",
)
def inventory_device_by_ip(spark, folder):
    return inv.device_by_ip(tables(spark, folder))


@query(
    "inventory_branch_by_prefix",
    f"""{WITH} SELECT lan_prefix AS prefix, branch_id, 'lan' AS segment FROM branches
    UNION ALL SELECT guest_prefix, branch_id, 'guest' FROM branches""",
)
def inventory_branch_by_prefix(spark, folder):
    return inv.branch_by_prefix(tables(spark, folder))


@query(
    "inventory_circuit_by_tunnel",
    f"""{WITH} SELECT tunnel_id, circuit_id, branch_id, provider, p.name AS provider_name, pop_id,
        role, bandwidth_mbps FROM circuits JOIN providers p ON p.code = provider""",
)
def inventory_circuit_by_tunnel(spark, folder):
    return inv.circuit_by_tunnel(tables(spark, folder))


@query(
    "inventory_branch",
    f"""{WITH} SELECT b.branch_id, b.region, b.size, b.router_id,
        split_part(b.switch_ids, '|', 1) AS payment_switch_id, c.provider AS primary_provider,
        b.primary_circuit_id
    FROM branches b JOIN circuits c ON c.circuit_id = b.primary_circuit_id""",
)
def inventory_branch(spark, folder):
    return inv.branch(tables(spark, folder))


@query(
    "inventory_branch_switches",
    f"""{WITH} SELECT branch_id, unnest(string_split(switch_ids, '|')) AS switch_id FROM branches""",
)
def inventory_branch_switches(spark, folder):
    return inv.branch_switches(tables(spark, folder))


@query("inventory_server_by_ip", f"{WITH} SELECT ip_num, server_id, app, dc FROM servers")
def inventory_server_by_ip(spark, folder):
    return inv.server_by_ip(tables(spark, folder))


@query(
    "inventory_app",
    f"""{WITH} SELECT a.name, a.category, a.criticality,
        CAST(coalesce(t.response_good_ms, 300) AS DOUBLE) AS response_good_ms,
        CAST(coalesce(t.response_bad_ms, 1000) AS DOUBLE) AS response_bad_ms,
        CAST(40 AS DOUBLE) AS rtt_good_ms,
        CAST(CASE WHEN t.app IS NULL THEN 100 ELSE 70 END AS DOUBLE) AS rtt_bad_ms,
        CAST(1 AS DOUBLE) AS retrans_good_pct,
        CAST(CASE WHEN t.app IS NULL THEN 3 ELSE 2 END AS DOUBLE) AS retrans_bad_pct
    FROM apps a LEFT JOIN sla_targets t ON t.app = a.name""",
)
def inventory_app(spark, folder):
    return inv.app(tables(spark, folder))


@query(
    "inventory_violations",
    f"""{WITH}
    SELECT 'backbone_ms > 0' AS rule, 'pops' AS table_name, pop_id AS "key" FROM pops
        WHERE backbone_ms <= 0
    UNION ALL SELECT 'size', 'branches', branch_id FROM branches WHERE size = 'huge'
    UNION ALL SELECT 'unique tunnel_id', 'circuits', CAST(tunnel_id AS VARCHAR) FROM circuits
        GROUP BY tunnel_id HAVING count(*) > 1
    UNION ALL SELECT DISTINCT 'branch_id in branches.branch_id', 'devices', branch_id FROM devices
        WHERE branch_id NOT IN (SELECT branch_id FROM branches)
    UNION ALL SELECT 'response bad > good', 'sla_targets', app FROM sla_targets
        WHERE response_bad_ms <= response_good_ms""",
)
def inventory_violations(spark, folder):
    return inv.violations(tables(spark, folder))


@query(
    "inventory_load",
    f"""{WITH}
    SELECT 'providers' AS table_name, count(*) AS n FROM providers
    UNION ALL SELECT 'pops', count(*) FROM pops
    UNION ALL SELECT 'gateways', count(*) FROM region
    UNION ALL SELECT 'branches', count(*) FROM branches
    UNION ALL SELECT 'circuits', count(*) FROM circuits
    UNION ALL SELECT 'devices', count(*) FROM devices
    UNION ALL SELECT 'servers', count(*) FROM servers
    UNION ALL SELECT 'apps', count(*) FROM apps
    UNION ALL SELECT 'sla_targets', count(*) FROM sla_targets""",
)
def inventory_load(spark, folder):
    """Write the tables as CSV files with a header, then read them all back strictly."""
    target = scratch_folder(spark, "inventory")
    for name, df in tables(spark, folder).items():
        df.write.csv(f"{target}/{name}.csv", header=True)
    loaded = inv.read_csv(spark, target)
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        for name, df in loaded.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "lookup_default",
    f"""{WITH}
    SELECT o_orderkey, coalesce(b.region, 'none') AS region, coalesce(b.router_id, '') AS router_id,
        b.branch_id IS NOT NULL AS known
    FROM orders LEFT JOIN branches b
        ON b.branch_id = CASE WHEN o_orderstatus = 'P' THEN 'B?' ELSE 'B-' END
            || CAST(o_custkey AS VARCHAR)""",
)
def lookup_default(spark, folder):
    made = tables(spark, folder)
    wanted = made["devices"].select(
        F.split_part("device_id", F.lit("-"), F.lit(2)).cast("bigint").alias("o_orderkey"),
        "branch_id",
    )
    found = lookup(
        wanted, made["branches"], {"branch_id": "branch_id"},
        {"region": ("region", "none"), "router_id": ("router_id", "")}, found="known",
    )
    return found.drop("branch_id")


@query(
    "lookup_as_table",
    f"""{WITH} SELECT provider, count(*) AS circuits FROM circuits WHERE role = 'primary'
    GROUP BY provider""",
)
def lookup_as_table(spark, folder):
    circuits = inv.circuit_by_tunnel(tables(spark, folder))
    primary = circuits.filter(F.col("role") == "primary")
    return primary.groupBy("provider").agg(F.count(F.lit(1)).alias("circuits"))
