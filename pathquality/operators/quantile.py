"""Exact quantiles per key without sorting or collecting a key's values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .sizing import fits_broadcast

ACCURACY = 5_000  # of the bracketing sketch: its rank error is at most n / ACCURACY
SMALL = 4_000  # keys with fewer values are ranked whole
ORDERED = 5_000_000  # a bracket expected to hold more values is cut into bins first
BINS = 1_024


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, q: float, out: str = "q"
) -> DataFrame:
    """Interpolated quantile of the non-NULL values, one row per key that has any.

    A first pass brackets the wanted ranks per key with a mergeable sketch. The second pass
    counts everything below and above the bracket into one row each before it is shuffled,
    so only the values inside (well under one percent of a large key) move and are ordered.
    Where even that is much for one key, the bracket is cut into bins, and only the bins that
    hold the wanted ranks are ordered. The result does not depend on the sketch: ranks are
    counted, and a bracket that missed would stop the query.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    slack = 5 / ACCURACY + 2 / SMALL
    low, high = max(q - slack, 0.0), min(q + slack, 1.0)
    sketch = F.percentile_approx("_x", [low, high], ACCURACY)
    bracket = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), sketch.alias("_b"))

    def bound(index: int, open_ended: bool) -> Column:
        whole = F.lit(open_ended) | (F.col("_n") <= SMALL)
        return F.when(~whole, F.col("_b")[index])  # NULL: no bound

    bracket = materialise(
        bracket.select(
            *keys, "_n", bound(0, low == 0).alias("_lo"), bound(1, high == 1).alias("_hi")
        )
    )
    largest = bracket.agg(F.max("_n")).first()[0] or 0
    bins = BINS if largest * 2 * slack > ORDERED else 1
    side = F.when(F.col("_x") < F.col("_lo"), -1).when(F.col("_x") > F.col("_hi"), 1).otherwise(0)
    counted = (
        _with_bounds(rows, bracket, keys)
        .select(*keys, side.alias("_side"), _bin(bins).alias("_bin"), "_x")
        .withColumns({c: F.when(F.col("_side") == 0, F.col(c)) for c in ("_x", "_bin")})
        .groupBy(*keys, "_side", "_bin", "_x")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    return _interpolate(_placed(counted, keys, q, bins), keys, out)


def _with_bounds(rows: DataFrame, bracket: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        only = bracket.first()  # one row: the bracket of all values
        return rows.withColumns({c: F.lit(only[c]).cast("double") for c in ("_lo", "_hi")})
    renamed = bracket.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_lo", "_hi")
    if fits_broadcast(renamed):
        renamed = F.broadcast(renamed)
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(renamed, on)


def _bin(bins: int) -> Column:
    """Position inside the bracket; equal widths suit a stretch this narrow."""
    if bins == 1:
        return F.lit(0)
    part = F.try_divide(F.col("_x") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    inside = F.greatest(F.lit(0.0), F.least(part * bins, F.lit(bins - 1.0)))
    return F.coalesce(F.floor(inside).cast("int"), F.lit(0))


def _placed(counted: DataFrame, keys: list[str], q: float, bins: int) -> DataFrame:
    """Each counted value with the rank after its last copy and the key's wanted position."""
    upto = (W.unboundedPreceding, W.currentRow)
    per_key = W.partitionBy(*keys)
    position = (F.sum("_c").over(per_key) - 1) * F.lit(float(q))
    if bins == 1:
        running = per_key.orderBy("_side", "_x").rowsBetween(*upto)
        return counted.select(
            *keys, "_side", "_x", "_c", F.sum("_c").over(running).alias("_end"),
            position.alias("_pos"),
        )
    group = ["_side", "_bin"]
    totals = counted.groupBy(*keys, *group).agg(F.sum("_c").alias("_c"))
    running = per_key.orderBy(*group).rowsBetween(*upto)
    ends = totals.select(
        *keys, *group, "_c", F.sum("_c").over(running).alias("_end"), position.alias("_pos")
    )
    wanted = ends.filter(_covers(F.floor("_pos")) | _covers(F.ceil("_pos"))).select(
        *[F.col(k).alias(f"_w_{k}") for k in [*keys, *group]],
        (F.col("_end") - F.col("_c")).alias("_before"),
        "_pos",
    )
    on = [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in [*keys, *group]]
    inside = W.partitionBy(*keys, *group).orderBy("_x").rowsBetween(*upto)
    return counted.join(wanted, on).select(
        *keys, "_side", "_x", "_c",
        (F.col("_before") + F.sum("_c").over(inside)).alias("_end"),
        "_pos",
    )


def _covers(rank: Column) -> Column:
    return (F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end"))


def _interpolate(placed: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Between the values at the two zero-based ranks around the position."""

    def at(rank: Column) -> Column:
        missed = F.raise_error(F.lit("quantile bracket missed the wanted rank"))
        found = F.when(F.col("_side") == 0, F.col("_x")).otherwise(missed.cast("double"))
        return F.max(F.when(_covers(rank), found))

    result = placed.groupBy(*keys).agg(
        at(F.floor("_pos")).alias("_lower"), at(F.ceil("_pos")).alias("_upper"),
        F.max("_pos").alias("_pos"),
    )
    share = F.col("_pos") - F.floor("_pos")
    between = F.col("_lower") * (F.lit(1.0) - share) + F.col("_upper") * share
    same = F.col("_lower") == F.col("_upper")
    return result.select(*keys, F.when(same, F.col("_lower")).otherwise(between).alias(out))
