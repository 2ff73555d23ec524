"""Default parameters. Everything here can be passed in by the caller."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class StitchSettings:
    """How half-flows are paired, when sessions are emitted and how they are judged."""

    safety_s: int = 10  # rows newer than this may still be in flight
    max_window_s: int = 120  # a backlog is worked off in windows of this length
    interval_s: int = 10
    recheck_offsets_s: tuple[int, ...] = (60, 300)
    idle_timeout_s: int = 900
    lookback_s: int = 86_400
    pair_tolerance_ms: int = 5_000
    probe_skew_ms: int = 50
    degraded_below: int = 70

    @property
    def slice_offsets_s(self) -> tuple[int, ...]:
        return tuple(sorted({0, *self.recheck_offsets_s, self.idle_timeout_s}))

    @property
    def live_reach_s(self) -> int:
        """How far behind its watermark the live job can still touch a session."""
        return max(self.slice_offsets_s) + self.max_window_s


# Targets for an application nobody has set targets for.
GENERIC_SLA = {
    "response_good_ms": 300.0,
    "response_bad_ms": 1000.0,
    "rtt_good_ms": 40.0,
    "rtt_bad_ms": 100.0,
    "retrans_good_pct": 1.0,
    "retrans_bad_pct": 3.0,
}

# Component weights of the session score.
SCORE_WEIGHTS = {"response": 0.4, "rtt": 0.4, "loss": 0.2}

# Accepted age of a record, in seconds before and after now.
ACCEPT_PAST_S = 7 * 86_400
ACCEPT_FUTURE_S = 3_600

# Days each table is kept.
RETENTION_DAYS = {
    "halfflows": 7,
    "queue": 2,
    "ingest_errors": 14,
    "sessions": 30,
    "quality_1m": 180,
    "element_1m": 180,
    "alerts": 90,
}
