"""Evaluates the alert rules tick after tick and keeps what it found.

A tick compares the results of all rules with the state the tick before has left and writes
one batch: every label set that is not normal, or was not. The batch is the state the next
tick starts from and, row by row, the history of alerts. A tick is journalled before it is
written and again after; after a crash the same tick is done again from the same state and
replaces what it left, so no firing is lost or raised twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import FAR_FUTURE, instant, last_minutes, naive_utc
from ..plans import alerts
from ..plans.localise import rank_elements
from ..plans.measures import Sketched
from ..sources.inventory import Lookups
from ..sources.store import ALERTING, Planned, Store, batch_name

Results = Callable[[datetime], dict[str, DataFrame]]


def live_results(store: Store, inventory: Callable[[], Lookups]) -> Results:
    """What every rule reads from the store; only the days its window touches are listed."""

    def at(now: datetime) -> dict[str, DataFrame]:
        since = now - timedelta(hours=1)
        quality, elements = store.read("quality_1m", since), store.read("element_1m", since)
        branches = inventory().branches
        recent = elements.filter(last_minutes(F.col("minute"), now, 5))
        return {
            "branch_degraded": alerts.branch_degraded(quality, branches, now),
            "fault_localised": alerts.fault_localised(rank_elements(recent, 20, 3)),
            "card_slow": alerts.card_slow(Sketched(quality), now),
            "on_backup": alerts.on_backup(quality, branches, now),
            "stitch_lag": alerts.lagging(store.watermarks(), now),
            "ingest_errors": alerts.ingest_errors(store.read("ingest_errors", since), now),
            "ingest_stopped": alerts.ingest_stopped(store.read("queue", since), now),
        }

    return at


class Alerting:
    def __init__(
        self, store: Store, results: Results, interval_s: int = 60,
        rules: dict[str, alerts.Rule] = alerts.RULES,
    ) -> None:
        self.store, self.results, self.interval_s, self.rules = store, results, interval_s, rules

    def _run(self, plan: Planned, again: bool) -> None:
        if again:
            self.store.discard("alerts", plan.batch_id)
        current = alerts.evaluations(self.results(plan.hi), self.rules)
        made = alerts.advance(current, self.standing(plan.lo), plan.hi, 2 * self.interval_s)
        self.store.write("alerts", made, plan.batch_id)
        self.store.note(ALERTING, 0, plan, "done", plan.hi)

    def standing(self, at: datetime) -> DataFrame:
        """The label sets that were pending or firing at a tick."""
        return self.store.read("alerts", at).filter(
            (F.col("evaluated_at") == instant(at)) & (F.col("state") != "normal"))

    def tick(self, now: datetime) -> bool:
        """Evaluate at `now`; False if this moment has been evaluated already."""
        now = naive_utc(now)
        unfinished = self.store.unfinished(ALERTING)
        if unfinished is not None:
            self._run(unfinished, again=True)
        last = self.store.watermark(ALERTING)
        if last is not None and last >= now:
            return False
        plan = Planned(batch_name(now, ALERTING), last or now, now, FAR_FUTURE)
        self.store.note(ALERTING, 0, plan, "planned", now)
        self._run(plan, again=False)
        return True

    def raised(self, since: datetime) -> DataFrame:
        """Every time an alert began to fire."""
        rows = self.store.read("alerts", since).filter(F.col("evaluated_at") >= instant(since))
        return rows.filter("state = 'firing' and previous <> 'firing'").select(
            "rule", "labels", "severity", "value", "since", "evaluated_at")

    def run_forever(self, clock: Callable[[], datetime], stopped: Callable[[], bool]) -> None:
        while not stopped():
            self.tick(clock())
            time.sleep(self.interval_s)
