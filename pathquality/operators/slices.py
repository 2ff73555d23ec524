"""Arrival-time slices of the work queue and the read bound they imply."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import EPOCH, instant


def in_slices(arrived: Column, lo: datetime, hi: datetime, offsets_s: Iterable[int]) -> Column:
    """True for arrivals in (lo, hi] or in the same window an offset earlier. Literal bounds
    joined by OR, so that file statistics can rule slices out."""
    shifted = [timedelta(seconds=o) for o in sorted(set(offsets_s))]
    return reduce(
        or_, [(arrived > instant(lo - s)) & (arrived <= instant(hi - s)) for s in shifted]
    )


def oldest_needed(
    touched: DataFrame, hi: datetime, lookback_s: int, slack_ms: int
) -> DataFrame:
    """One row: the oldest `first_seen` a window has to read. A queue row without one
    (epoch) forces the full lookback."""
    oldest = F.when(
        F.count_if(F.col("first_seen") == instant(EPOCH)) > 0, instant(EPOCH)
    ).otherwise(F.timestamp_micros(F.unix_micros(F.min("first_seen")) - slack_ms * 1000))
    floor = instant(hi - timedelta(seconds=lookback_s))
    return touched.agg(
        F.greatest(floor, oldest).alias("since"), F.count(F.lit(1)).alias("queued")
    )
