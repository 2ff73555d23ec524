"""As-of joins: each left row takes the nearest right row at or after it.

The work is split by key *and* time, so one key holding most of the rows still spreads
over the cluster, and every row is handled in one sorted pass: no pairs are generated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_AT, _LEFT, _PAYLOAD, _BLOCK = "_asof_at", "_asof_left", "_asof_payload", "_asof_block"


def nearest_following(
    rows: DataFrame,
    on: Sequence[str],
    is_left: Column,
    at_us: Column,
    payload: Column,
    reach_us: int,
    out: str,
) -> DataFrame:
    """Within one frame holding both sides, give each left row the payload of the nearest
    right row with the same key at or after `at_us`, as struct column `out`.

    Right rows more than `reach_us` later may be missed, so the caller must not need them.
    Time is cut into blocks of `reach_us`; a right row serves its own block and the one
    before it, which is as far as a left row within reach can be.
    """
    width = max(int(reach_us), 1)
    block = F.floor(F.col(_AT) / width)
    blocks = F.when(F.col(_LEFT), F.array(block)).otherwise(F.array(block, block - 1))
    tagged = (
        rows.withColumns({_LEFT: is_left, _AT: at_us})
        .withColumn(_PAYLOAD, F.when(~F.col(_LEFT), payload))
        .withColumn(_BLOCK, F.explode(blocks))
    )
    # newest first; on equal times the right row comes first, so it can still be taken
    order = W.partitionBy(*on, _BLOCK).orderBy(F.col(_AT).desc(), F.col(_LEFT).asc())
    seen = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        tagged.withColumn(out, F.last(_PAYLOAD, ignorenulls=True).over(seen))
        .filter(F.col(_LEFT))
        .drop(_AT, _LEFT, _PAYLOAD, _BLOCK)
    )


def _stack(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_at: Column, right_at: Column
) -> DataFrame:
    """Both sides in one frame: left columns as one struct, right columns as another."""
    keyed = right
    for name in on:
        keyed = keyed.filter(F.col(name).isNotNull())  # NULL keys never match
    left_part = left.select(
        *on, left_at.alias("at_us"), F.struct(*left.columns).alias("l"), F.lit(True).alias("is_l")
    )
    right_part = keyed.select(
        *on, right_at.alias("at_us"), F.struct(*right.columns).alias("r"), F.lit(False).alias("is_l")
    )
    return left_part.unionByName(right_part, allowMissingColumns=True)


def _unstack(df: DataFrame, left: DataFrame, right: DataFrame, on: Sequence[str], prefix: str):
    right_cols = [c for c in right.columns if c not in on]
    return df.select(
        *[F.col(f"l.{c}").alias(c) for c in left.columns],
        *[F.col(f"hit.{c}").alias(prefix + c) for c in right_cols],
        F.col("hit").isNotNull().alias(prefix + "matched"),
    )


def asof_join_within(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    tolerance_ms: int,
    skew_ms: int = 0,
    prefix: str = "r_",
) -> DataFrame:
    """Left as-of join whose match must also lie within `tolerance_ms` (either side).

    The right row may be up to `skew_ms` earlier than the left row. A nearest row beyond
    the tolerance counts as no match. Right columns come out with `prefix`.
    """
    left_at = F.unix_micros(left_time) - skew_ms * 1000
    stacked = _stack(left, right, on, left_at, F.unix_micros(right_time))
    found = nearest_following(
        stacked,
        on,
        F.col("is_l"),
        F.col("at_us"),
        F.col("r"),
        (tolerance_ms + skew_ms) * 1000 + 1000,
        "hit",
    )
    apart = F.unix_millis(f"hit.{right_time}") - F.unix_millis(f"l.{left_time}")
    kept = found.withColumn("hit", F.when(F.abs(apart) <= tolerance_ms, F.col("hit")))
    return _unstack(kept, left, right, on, prefix)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    skew_ms: int = 0,
    block_s: int = 86_400,
    prefix: str = "r_",
) -> DataFrame:
    """Left as-of join without an upper bound.

    Blocks of `block_s` are searched on their own. A left row that finds nothing in its
    block takes the first right row of the next block that has one; that table has one row
    per key and block, whatever the traffic.
    """
    left_at = F.unix_micros(left_time) - skew_ms * 1000
    stacked = _stack(left, right, on, left_at, F.unix_micros(right_time)).withColumn(
        "block", F.floor(F.col("at_us") / (block_s * 1_000_000))
    )
    local = W.partitionBy(*on, "block").orderBy(F.col("at_us").desc(), F.col("is_l").asc())
    within = stacked.withColumn(
        "hit",
        F.last("r", ignorenulls=True).over(
            local.rowsBetween(W.unboundedPreceding, W.currentRow)
        ),
    ).filter("is_l")

    heads = stacked.groupBy(*on, "block").agg(F.min_by("r", F.when(~F.col("is_l"), F.col("at_us"))).alias("head"))
    later = W.partitionBy(*on).orderBy(F.col("block").desc())
    carried = heads.select(
        *on,
        "block",
        F.last("head", ignorenulls=True)
        .over(later.rowsBetween(W.unboundedPreceding, -1))
        .alias("next_head"),
    )
    joined = within.join(carried, [*on, "block"], "left").withColumn(
        "hit", F.coalesce("hit", "next_head")
    )
    return _unstack(joined, left, right, on, prefix)


def range_join_nearest(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_id: Sequence[str],
    left_time: str,
    right_time: str,
    tolerance_ms: int,
    skew_ms: int = 0,
    prefix: str = "r_",
) -> DataFrame:
    """The same result by an equi join on key and time block plus a range predicate.

    Kept as an independent check of `asof_join_within`; it builds the pairs in range, so
    the sorted form above is the one to use. `left_id` identifies a left row.
    """
    width = (tolerance_ms + skew_ms) * 1000 + 1000
    right_cols = [c for c in right.columns if c not in on]
    from_us = F.unix_micros(left_time) - skew_ms * 1000
    lefts = left.withColumn("from_us", from_us).withColumn("blk", F.floor(F.col("from_us") / width))
    at = F.floor(F.unix_micros(right_time) / width)
    rights = right.select(
        *on,
        F.unix_micros(right_time).alias("at_us"),
        F.struct(*right_cols).alias("r"),
        F.explode(F.array(at, at - 1)).alias("blk"),
    )
    best = (
        lefts.select(*on, *[c for c in left_id if c not in on], "from_us", "blk")
        .join(rights, [*on, "blk"])
        .filter((F.col("at_us") >= F.col("from_us")) & (F.col("at_us") <= F.col("from_us") + width))
        .groupBy(*left_id)
        .agg(F.min_by("r", "at_us").alias("hit"))
    )
    apart = F.unix_millis(f"hit.{right_time}") - F.unix_millis(left_time)
    joined = left.join(best, list(left_id), "left").withColumn(
        "hit", F.when(F.abs(apart) <= tolerance_ms, F.col("hit"))
    )
    return joined.select(
        *left.columns,
        *[F.col(f"hit.{c}").alias(prefix + c) for c in right_cols],
        F.col("hit").isNotNull().alias(prefix + "matched"),
    )
