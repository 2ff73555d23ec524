"""Mergeable sketch states kept in rollups, and how to read them.

Quantiles use KLL sketches, distinct counts HLL sketches: both have bounded size, so a
rollup row does not grow with the traffic behind it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantile_state(value: Column) -> Column:
    return F.kll_sketch_agg_double(value.cast("double"))  # NULLs are skipped


def merge_quantiles(state: Column) -> Column:
    return F.kll_merge_agg_double(state)


def read_quantile(state: Column, q: float) -> Column:
    """NULL for a sketch that has seen no value (asking it directly is an error)."""
    filled = F.when(F.kll_sketch_get_n_double(state) > 0, state)
    return F.kll_sketch_get_quantile_double(filled, F.lit(q))


def distinct_state(value: Column) -> Column:
    return F.hll_sketch_agg(value)


def merge_distinct(state: Column) -> Column:
    return F.hll_union_agg(state)


def read_distinct(state: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(state), F.lit(0)).cast("bigint")
