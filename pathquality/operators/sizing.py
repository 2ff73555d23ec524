"""Decide whether a side may be broadcast, by measuring it first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 1_000_000
MAX_BYTES = 128 << 20


def row_width(df: DataFrame) -> Column:
    """Rough bytes of a row in memory."""
    width = F.lit(16)
    for field in df.schema.fields:
        text = F.col(f"`{field.name}`").cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(16)
    return width


def fits_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Counts at most max_rows + 1 rows, so the check itself stays small."""
    head = df.limit(max_rows + 1)
    row = head.agg(F.count(F.lit(1)).alias("n"), F.sum(row_width(df)).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def small(df: DataFrame) -> DataFrame:
    """Broadcast where the measured size allows, else left to Catalyst."""
    return F.broadcast(df) if fits_broadcast(df) else df
