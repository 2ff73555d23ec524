"""The network inventory: CSV load, lookup views and integrity rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.network import ipv4_number
from ..settings import GENERIC_SLA
from . import schemas
from .files import delete, exists, join

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Lookups:
    """The six tables enrichment reads."""

    devices: DataFrame  # ip_num, device_id, device_type, branch_id, switch_id
    prefixes: DataFrame  # prefix, branch_id, segment
    circuits: DataFrame  # tunnel_id, circuit_id, branch_id, provider, ..., pop_id, role
    branches: DataFrame  # branch_id, region, size, router_id, ..., primary_*
    servers: DataFrame  # ip_num, server_id, app, dc
    apps: DataFrame  # name, category, criticality, six targets


# --- loading ------------------------------------------------------------------------


def read_csv(spark: SparkSession, folder: str, seeds: str | None = None) -> dict[str, DataFrame]:
    """All nine files, or an error naming the ones that are missing. A value that does not
    fit its column fails the read."""
    where = {t: join(seeds if seeds and t == "sla_targets" else folder, f"{t}.csv")
             for t in schemas.INVENTORY}
    missing = [p for p in where.values() if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"inventory files missing: {missing}")
    return {
        table: spark.read.csv(
            where[table], header=True, schema=ddl, mode="FAILFAST", enforceSchema=False
        )
        for table, ddl in schemas.INVENTORY.items()
    }


def publish(spark: SparkSession, tables: Tables, root: str, version: str) -> dict[str, int]:
    """Write a complete version next to the old ones, then name it current. Refuses an
    inventory that breaks a rule. Returns the row count per table."""
    broken = violations(tables)
    if not broken.isEmpty():
        sample = [f"{r['rule']} {r['table_name']} {r['key']}" for r in broken.limit(10).collect()]
        raise ValueError(f"inventory breaks its rules: {sample}")
    counts = {}
    for name in schemas.INVENTORY:
        path = join(root, f"version={version}", name)
        tables[name].write.mode("overwrite").parquet(path)
        counts[name] = spark.read.parquet(path).count()
    pointer = spark.createDataFrame([(version,)], "version string")
    pointer.coalesce(1).write.mode("append").parquet(join(root, "current"))
    return counts


def current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest published version (versions sort by name)."""
    version = spark.read.parquet(join(root, "current")).agg(F.max("version")).first()[0]
    return {
        name: spark.read.schema(ddl).parquet(join(root, f"version={version}", name))
        for name, ddl in schemas.INVENTORY.items()
    }


def drop_version(spark: SparkSession, root: str, version: str) -> None:
    delete(spark, join(root, f"version={version}"))


# --- views --------------------------------------------------------------------------


def device_by_ip(t: Tables) -> DataFrame:
    return (
        t["devices"]
        .filter(F.col("device_type") != "guest")
        .select(
            ipv4_number(F.col("ip")).alias("ip_num"),
            "device_id", "device_type", "branch_id", "switch_id",
        )
    )


def branch_by_prefix(t: Tables) -> DataFrame:
    def segment(column: str, name: str) -> DataFrame:
        return t["branches"].select(
            F.col(column).alias("prefix"), "branch_id", F.lit(name).alias("segment")
        )

    return segment("lan_prefix", "lan").unionByName(segment("guest_prefix", "guest"))


def circuit_by_tunnel(t: Tables) -> DataFrame:
    providers = t["providers"].select(
        F.col("code").alias("provider"), F.col("name").alias("provider_name")
    )
    return t["circuits"].join(providers, "provider").select(
        "tunnel_id", "circuit_id", "branch_id", "provider", "provider_name", "pop_id", "role",
        "bandwidth_mbps",
    )


def branch(t: Tables) -> DataFrame:
    primary = t["circuits"].select(
        F.col("circuit_id").alias("primary_circuit_id"),
        F.col("provider").alias("primary_provider"),
    )
    return t["branches"].join(primary, "primary_circuit_id").select(
        "branch_id", "region", "size", "router_id",
        F.split_part("switch_ids", F.lit("|"), F.lit(1)).alias("payment_switch_id"),
        "primary_provider", "primary_circuit_id",
    )


def branch_switches(t: Tables) -> DataFrame:
    """The '|' separated switch list, one row per switch."""
    return t["branches"].select(
        "branch_id", F.explode(F.split("switch_ids", r"\|")).alias("switch_id")
    )


def server_by_ip(t: Tables) -> DataFrame:
    return t["servers"].select(ipv4_number(F.col("ip")).alias("ip_num"), "server_id", "app", "dc")


def app(t: Tables) -> DataFrame:
    """An app without targets keeps its category and gets the generic targets."""
    targets = t["sla_targets"].withColumnRenamed("app", "name")
    return t["apps"].join(targets, "name", "left").select(
        "name", "category", "criticality",
        *[F.coalesce(F.col(c).cast("double"), F.lit(v)).alias(c) for c, v in GENERIC_SLA.items()],
    )


def lookups(t: Tables) -> Lookups:
    return Lookups(
        devices=device_by_ip(t),
        prefixes=branch_by_prefix(t),
        circuits=circuit_by_tunnel(t),
        branches=branch(t),
        servers=server_by_ip(t),
        apps=app(t),
    )


# --- integrity ----------------------------------------------------------------------

# Identifying columns, references and required values of the inventory.
UNIQUE = (
    ("providers", ("code",)), ("providers", ("name",)),
    ("pops", ("pop_id",)), ("pops", ("provider", "region")),
    ("gateways", ("gateway_id",)),
    ("branches", ("branch_id",)), ("branches", ("index",)), ("branches", ("lan_prefix",)),
    ("branches", ("guest_prefix",)), ("branches", ("router_id",)),
    ("circuits", ("circuit_id",)), ("circuits", ("tunnel_id",)),
    ("circuits", ("branch_id", "role")),
    ("devices", ("device_id",)), ("devices", ("ip",)),
    ("servers", ("server_id",)), ("servers", ("ip",)),
    ("apps", ("name",)),
    ("sla_targets", ("app",)),
)
REFERENCES = (
    ("pops", "provider", "providers", "code"),
    ("circuits", "branch_id", "branches", "branch_id"),
    ("circuits", "provider", "providers", "code"),
    ("circuits", "pop_id", "pops", "pop_id"),
    ("branches", "primary_circuit_id", "circuits", "circuit_id"),
    ("branches", "backup_circuit_id", "circuits", "circuit_id"),
    ("devices", "branch_id", "branches", "branch_id"),
    ("sla_targets", "app", "apps", "name"),
)


def _checks() -> list[tuple[str, str, str, Column]]:
    """(table, key column, rule, what must hold)."""
    c = F.col
    return [
        ("pops", "pop_id", "backbone_ms > 0", c("backbone_ms") > 0),
        ("branches", "branch_id", "size", c("size").isin("small", "medium", "large", "flagship")),
        ("circuits", "circuit_id", "role", c("role").isin("primary", "backup")),
        ("circuits", "circuit_id", "bandwidth_mbps > 0", c("bandwidth_mbps") > 0),
        ("apps", "name", "criticality", c("criticality").isin("critical", "business", "bulk")),
        ("apps", "name", "hosted", c("hosted").isin("dc", "internet")),
        ("sla_targets", "app", "response bad > good",
         c("response_bad_ms") > c("response_good_ms")),
        ("sla_targets", "app", "rtt bad > good", c("rtt_bad_ms") > c("rtt_good_ms")),
        ("sla_targets", "app", "retrans bad > good",
         c("retrans_bad_pct") > c("retrans_good_pct")),
    ]


def duplicate_keys(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    key = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
    grouped = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return grouped.select(
        F.lit("unique " + ",".join(columns)).alias("rule"), F.lit(table).alias("table_name"),
        key.alias("key"),
    )


def dangling(df: DataFrame, table: str, column: str, target: DataFrame, target_col: str,
             target_name: str) -> DataFrame:
    """Values of `column` that do not exist in the referenced table."""
    known = target.select(F.col(target_col).alias(column))
    return (
        df.select(column).filter(F.col(column).isNotNull()).distinct()
        .join(known, column, "left_anti")
        .select(
            F.lit(f"{column} in {target_name}.{target_col}").alias("rule"),
            F.lit(table).alias("table_name"), F.col(column).cast("string").alias("key"),
        )
    )


def violations(t: Tables) -> DataFrame:
    """Every broken rule as (rule, table_name, key). Columns are all required."""
    found = []
    for table, columns in UNIQUE:
        found.append(duplicate_keys(t[table], table, columns))
    for table, column, target, target_col in REFERENCES:
        found.append(dangling(t[table], table, column, t[target], target_col, target))
    for table, key, rule, holds in _checks():
        found.append(
            t[table].filter(holds == F.lit(False)).select(
                F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                F.col(key).cast("string").alias("key"),
            )
        )
    for table in schemas.INVENTORY:
        absent = F.array_compact(
            F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in t[table].columns])
        )
        first = t[table].columns[0]
        found.append(
            t[table].select(F.explode(absent).alias("c"), F.col(first).cast("string").alias("k"))
            .select(
                F.concat(F.lit("required "), "c").alias("rule"), F.lit(table).alias("table_name"),
                F.col("k").alias("key"),
            )
        )
    return reduce(DataFrame.unionByName, found)
