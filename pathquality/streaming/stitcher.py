"""Runs the stitch kernel window after window: live, catching up, or over the past.

The plan of a window is journalled before anything is written and again when all of its
tables are written. After a crash the same window is done again, so sessions and rollups
of a batch always belong together.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..functions.clock import FAR_FUTURE, naive_utc
from ..plans.rollup import element_1m, quality_1m
from ..plans.stitch import Window, next_window, stitch_window, tile
from ..settings import StitchSettings
from ..sources.inventory import Lookups
from ..sources.store import Planned, Store, batch_name

JOB, REPAIR = "stitch", "restitch"


class Stitcher:
    """`inventory` is called for every window, so changed tables are picked up."""

    def __init__(
        self,
        store: Store,
        inventory: Callable[[], Lookups],
        settings: StitchSettings = StitchSettings(),
        shard: int = 0,
    ) -> None:
        self.store, self.inventory, self.settings, self.shard = store, inventory, settings, shard

    def _watermark(self, now: datetime) -> datetime:
        """Where live stitching stands; at first, just before the oldest queued record."""
        known = self.store.watermark(JOB, self.shard)
        if known is not None:
            return known
        oldest = self.store.read("queue").agg(F.min("ingested_at")).first()[0]
        return now if oldest is None else oldest - timedelta(milliseconds=1)

    def _run(self, job: str, plan: Planned, now: datetime, again: bool) -> int:
        store, settings = self.store, self.settings
        if again:
            for table in ("sessions", "quality_1m", "element_1m"):
                store.discard(table, plan.batch_id)
        earliest = plan.hi - timedelta(seconds=settings.lookback_s, days=1)
        since = None if earliest < datetime(1970, 1, 2) else earliest
        written = store.read("sessions", since).filter(F.col("batch_id") != plan.batch_id)
        made = stitch_window(
            store.read("halfflows", since),
            store.read("queue", since),
            written,
            self.inventory(),
            Window(plan.lo, plan.hi),
            now,
            settings,
            plan.live_from,
        )
        count = 0
        if made is not None:
            store.write("sessions", made, plan.batch_id)
            # read back: the rollups must describe exactly what was stored
            stored = store.read("sessions", since, batch_id=plan.batch_id)
            count = stored.count()
            store.write("quality_1m", quality_1m(stored), plan.batch_id)
            store.write("element_1m", element_1m(stored), plan.batch_id)
        store.note(job, self.shard, plan, "done", now)
        return count

    def _repair(self, job: str, now: datetime) -> int:
        total = 0
        while (plan := self.store.unfinished(job, self.shard)) is not None:
            total += self._run(job, plan, now, again=True)
        return total

    def tick(self, now: datetime) -> tuple[int, bool]:
        """Stitch the next window: (sessions written, whether more backlog is waiting)."""
        now = naive_utc(now)
        redone = self._repair(JOB, now)
        # the journal of ingest first: what begins later is stamped later than this window
        arriving = self.store.arriving_since()
        window = next_window(self._watermark(now), now, self.settings, arriving)
        if window is None:
            return redone, False
        plan = Planned(batch_name(now, f"live-{_ms(window.hi)}"), window.lo, window.hi, FAR_FUTURE)
        self.store.note(JOB, self.shard, plan, "planned", now)
        count = self._run(JOB, plan, now, again=False)
        full = window.hi - window.lo >= timedelta(seconds=self.settings.max_window_s)
        return redone + count, full

    def catch_up(self, now: datetime) -> int:
        """Ticks until no full window is left."""
        total, more = 0, True
        while more:
            count, more = self.tick(now)
            total += count
        return total

    def run_forever(self, clock: Callable[[], datetime], stopped: Callable[[], bool]) -> None:
        while not stopped():
            _, more = self.tick(clock())
            if not more:
                time.sleep(self.settings.interval_s)

    def restitch(self, since: datetime, until: datetime, now: datetime) -> int:
        """Fill gaps in the past without moving the watermark. Ends before anything live
        stitching can still touch, so the two never write the same session."""
        now, total = naive_utc(now), self._repair(REPAIR, naive_utc(now))
        reach = timedelta(seconds=self.settings.live_reach_s)
        end = min(naive_utc(until), self._watermark(now) - reach)
        for window in tile(naive_utc(since), end, self.settings.max_window_s):
            name = batch_name(now, f"fill-{_ms(window.hi)}")
            plan = Planned(name, window.lo, window.hi, end)
            self.store.note(REPAIR, self.shard, plan, "planned", now)
            total += self._run(REPAIR, plan, now, again=True)
        return total


def _ms(moment: datetime) -> str:
    return f"{int((moment - datetime(1970, 1, 1)).total_seconds() * 1000):015d}"


__all__ = ["Stitcher", "JOB", "REPAIR"]
