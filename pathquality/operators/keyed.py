"""One row per key, and bounded per-key lists. All of them combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ties = [c for c in rest if c not in order]
    chosen = pick(F.struct(*rest), F.struct(*order, *ties)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order`; the other columns break ties, so a rerun agrees."""
    return _pick(df, keys, order, F.max_by)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def bounded_distinct(
    df: DataFrame, keys: Sequence[str], value: str, size: int = 16, out: str = "items"
) -> DataFrame:
    """The first `size` distinct values per key, sorted.

    Duplicates go first and the rank limit runs before the rows move, so no list ever
    holds more than `size` values.
    """
    ranked = (
        df.filter(F.col(value).isNotNull())
        .select(*keys, value)
        .distinct()
        .withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(value)))
        .filter(F.col("_rank") <= size)
    )
    return ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(out))


def heaviest_item(
    df: DataFrame, keys: Sequence[str], item: str, weight: str, out: str = "top_item"
) -> DataFrame:
    """The item with the largest total weight per key (the greatest name on a tie); '' when
    all weights are zero."""
    totals = df.groupBy(*keys, item).agg(F.sum(weight).alias("_w"))
    best = totals.groupBy(*keys).agg(
        F.max_by(item, F.struct("_w", item)).alias(out), F.max("_w").alias("_w")
    )
    return best.withColumn(out, F.when(F.col("_w") > 0, F.col(out)).otherwise("")).drop("_w")
