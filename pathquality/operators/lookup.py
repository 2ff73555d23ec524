"""Keyed lookups with defaults and longest-prefix match.

Plain lookups are left joins without hints: Catalyst broadcasts the table while its size
is under the session's threshold and shuffles beyond it, and AQE splits a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.network import ipv4_number, network_of, prefix_length
from .sizing import MAX_BYTES, MAX_ROWS, row_width


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: Mapping[str, str],
    take: Mapping[str, tuple[str, object]],
    found: str | None = None,
) -> DataFrame:
    """Left join `table` on `key` ({df column: table column}) and add the `take` columns
    ({new column: (table column, default)}). The table must have one row per key.

    A default of None leaves NULL; `found` names a boolean that says whether the key exists.
    """
    side = table.select(
        *[F.col(t).alias(f"_k{i}") for i, t in enumerate(key.values())],
        F.struct(
            F.lit(True).alias("_hit"),
            *[F.col(c).alias(f"_v{i}") for i, (c, _) in enumerate(take.values())],
        ).alias("_row"),
    )
    condition = [F.col(d) == F.col(f"_k{i}") for i, d in enumerate(key)]
    added = {}
    for i, (name, (_, default)) in enumerate(take.items()):
        value = F.col(f"_row._v{i}")
        added[name] = value if default is None else F.coalesce(value, F.lit(default))
    if found:
        added[found] = F.col("_row._hit").isNotNull()
    drop = ["_row", *[f"_k{i}" for i in range(len(key))]]
    return df.join(side, condition, "left").withColumns(added).drop(*drop)


def prefix_table(prefixes: DataFrame, cidr: str, *values: str) -> DataFrame:
    """CIDR text as (net, len, values); a prefix listed twice keeps its smallest row."""
    length = prefix_length(F.col(cidr))
    number = ipv4_number(F.split_part(F.col(cidr), F.lit("/"), F.lit(1)))
    return (
        prefixes.select(
            network_of(number, length).alias("net"),
            length.alias("len"),
            F.struct(*values).alias("val"),
        )
        .groupBy("net", "len")
        .agg(F.min("val").alias("val"))
    )


def longest_prefix_match(
    df: DataFrame,
    address: Column,
    prefixes: DataFrame,
    take: Mapping[str, tuple[str, object]],
    max_broadcast_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add the `take` columns of the longest prefix covering `address` (a number).

    `prefixes` comes from `prefix_table`. A table measured to be small is broadcast and
    probed once per prefix length in use (33 at most). A larger one is matched against the
    distinct addresses only, which are then joined back.
    """
    measured = (
        prefixes.groupBy("len")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(row_width(prefixes)).alias("b"))
        .collect()  # one row per prefix length
    )
    lengths = sorted((r["len"] for r in measured), reverse=True)
    rows, size = (sum(r[c] for r in measured) for c in ("n", "b"))
    base = df.withColumn("_ip", address)
    if rows <= max_broadcast_rows and size <= MAX_BYTES:
        hits = []
        for n in lengths:
            side = prefixes.filter(F.col("len") == n).select(
                F.col("net").alias(f"_net{n}"), F.col("val").alias(f"_hit{n}")
            )
            base = base.join(
                F.broadcast(side), network_of(F.col("_ip"), n) == F.col(f"_net{n}"), "left"
            )
            hits.append(F.col(f"_hit{n}"))
        best = F.coalesce(*hits) if hits else F.lit(None).cast(prefixes.schema["val"].dataType)
        drop = ["_ip", *[f"_net{n}" for n in lengths], *[f"_hit{n}" for n in lengths]]
    else:
        candidates = (
            base.select("_ip")
            .filter(F.col("_ip").isNotNull())
            .distinct()
            .withColumn("len", F.explode(F.array(*[F.lit(n) for n in lengths])))
            .withColumn("net", network_of(F.col("_ip"), F.col("len")))
        )
        matches = (
            candidates.join(prefixes, ["net", "len"])
            .groupBy("_ip")
            .agg(F.max_by("val", "len").alias("_hit"))
        )
        base = base.join(matches, "_ip", "left")
        best = F.col("_hit")
        drop = ["_ip", "_hit"]
    added = {}
    for name, (column, default) in take.items():
        value = best.getField(column)
        added[name] = value if default is None else F.coalesce(value, F.lit(default))
    return base.withColumns(added).drop(*drop)
