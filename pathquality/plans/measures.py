"""Two ways to read quantiles and distinct counts: from the sketches of a rollup, or
exactly from sessions. Panels take either."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sketches as sk
from ..operators.quantile import exact_quantile


@dataclass(frozen=True)
class Sketched:
    """Reads rollup rows; approximate, bounded memory."""

    frame: DataFrame

    def quantile(self, df: DataFrame, keys: Sequence[str], column: str, q: float, out: str):
        merged = sk.merge_quantiles(F.col(column))
        return df.groupBy(*keys).agg(sk.read_quantile(merged, q).alias(out))

    def devices(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.groupBy(*keys).agg(
            *[
                sk.read_distinct(sk.merge_distinct(F.col(c))).alias(c)
                for c in ("devices", "degraded_devices")
            ]
        )


@dataclass(frozen=True)
class Exact:
    """Reads one row per session, with the rollup's key columns."""

    frame: DataFrame

    def quantile(self, df: DataFrame, keys: Sequence[str], column: str, q: float, out: str):
        return exact_quantile(df, keys, column, q, out)

    def devices(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        seen = df.groupBy(*keys, "device_id").agg(F.bool_or("degraded").alias("degraded"))
        return seen.groupBy(*keys).agg(
            F.count("device_id").alias("devices"),
            F.count_if(F.col("degraded") & F.col("device_id").isNotNull()).alias(
                "degraded_devices"
            ),
        )


Measures = Sketched | Exact
