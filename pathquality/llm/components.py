"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(pairs: DataFrame, larger: bool) -> DataFrame:
    """Join every node's neighbours (only the larger ones, or itself and the smaller ones) to
    the smallest of them. Both sides of the join are narrow, and the grouped side combines
    before its shuffle, so a hub costs no more than its edges."""
    u, v = F.col("u"), F.col("v")
    if larger:
        both = pairs.unionByName(pairs.select(v.alias("u"), u.alias("v")))
    else:
        both = pairs.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.filter(v > u).select(v.alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(v.alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(u != v).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`edges` (`u`, `v`: long) to (`node`, `root`): the smallest node each one reaches. Nodes
    without an edge are not listed. Every round is written, so no lineage grows."""
    pairs = stored(edges.select("u", "v").filter("u != v").distinct(), "components")
    before = None
    while True:
        state = pairs.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
            F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        pairs = stored(_stars(_stars(pairs, True), False), "components")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select("v", "v").toDF("node", "root").distinct())
