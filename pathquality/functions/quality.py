"""Timings and the 0-100 score of one stitched session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import SCORE_WEIGHTS
from .numeric import round_even

TCP = 6


def _gap_ms(start_us: Column, end_us: Column, usable: Column) -> Column:
    """Milliseconds between two observed packets, NULL unless both were seen in order."""
    return F.when(usable & (start_us > 0) & (end_us > start_us), (end_us - start_us) / 1000.0)


def add_timings(df: DataFrame) -> DataFrame:
    """Needs ip_proto, matched, the *_us packet times and both halves' packet counts."""
    usable = (F.col("ip_proto") == TCP) & F.col("matched")
    return df.withColumns(
        {
            "no_return": (F.col("ip_proto") == TCP) & ~F.col("matched"),
            "server_rtt": _gap_ms(F.col("syn_us"), F.col("s_synack_us"), usable),
            "client_rtt": _gap_ms(F.col("s_synack_us"), F.col("ack_us"), usable),
            "response": _gap_ms(F.col("req_us"), F.col("s_resp_us"), usable),
            "retrans_share": F.lit(100.0)
            * (F.col("retrans") + F.col("s_retrans"))
            / F.greatest(F.lit(1), F.col("packets") + F.col("s_packets")),
        }
    )


def _attainment(value: Column, good: Column, bad: Column) -> Column:
    """1 at or better than `good`, 0 at or worse than `bad`, linear between, NULL if unmeasured."""
    scaled = (bad - value) / (bad - good)
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)))


def add_score(df: DataFrame, degraded_below: int) -> DataFrame:
    """Needs the timing columns and the six SLA target columns (as doubles).

    The weights are shared out again over the components that could be measured.
    """
    parts = {
        "response": _attainment(
            F.col("response"), F.col("response_good_ms"), F.col("response_bad_ms")
        ),
        "rtt": _attainment(F.col("client_rtt"), F.col("rtt_good_ms"), F.col("rtt_bad_ms")),
        "loss": _attainment(
            F.col("retrans_share"), F.col("retrans_good_pct"), F.col("retrans_bad_pct")
        ),
    }
    earned = possible = F.lit(0.0)
    for name, weight in SCORE_WEIGHTS.items():
        earned = earned + F.coalesce(parts[name], F.lit(0.0)) * weight
        possible = possible + F.when(parts[name].isNull(), 0.0).otherwise(weight)
    quality = (
        F.when(F.col("no_return"), F.lit(0))
        .otherwise(round_even(F.lit(100.0) * earned / possible))
        .cast("int")
    )
    slow_path = F.coalesce(F.col("client_rtt") > F.col("rtt_bad_ms"), F.lit(False))
    return df.withColumn("quality", quality).withColumns(
        {
            "degraded": F.col("quality") < degraded_below,
            "net_degraded": F.col("no_return")
            | (F.col("retrans_share") > F.col("retrans_bad_pct"))
            | slow_path,
        }
    )
