"""The alert job: state from tick to tick, restarts, and its rules on real tables."""

from __future__ import annotations

from datetime import timedelta

import pytest

from pathquality import __main__ as jobs
from pathquality.plans import alerts
from pathquality.sources.store import ALERTING, Planned, Store
from pathquality.streaming.alerting import Alerting

from .network import at, inventory_tables

RULES = {r.name: r for r in (
    alerts.Rule("slow", "p95", above=10, hold_s=120, severity="critical"),
    alerts.Rule("quiet", "n", below=1, hold_s=0, no_data="alerting"),
)}


class Feed:
    """What the rules see at each minute: (branch, p95) rows and one count."""

    def __init__(self, spark, slow, quiet):
        self.spark, self.slow, self.quiet = spark, slow, quiet

    def __call__(self, now):
        minute = int((now - at(0)).total_seconds()) // 60
        rows = [(b, float(p)) for b, p in self.slow.get(minute, [])]
        return {
            "slow": self.spark.createDataFrame(rows, "branch string, p95 double"),
            "quiet": self.spark.createDataFrame([(self.quiet.get(minute, 5),)], "n long"),
        }


SLOW = {0: [("a", 5), ("b", 20)], 1: [("a", 11), ("b", 21)], 2: [("a", 12), ("a", 3), ("b", 22)], 3: [("a", 13)],
        4: [("a", 9), ("b", 30)]}
STATES = {
    0: {("b", "normal", "pending", 0)},
    1: {("a", "normal", "pending", 1), ("b", "pending", "pending", 0)},
    2: {("a", "pending", "pending", 1), ("b", "pending", "firing", 0), ("", "normal", "firing", 2)},
    3: {("a", "pending", "firing", 1), ("b", "firing", "normal", None), ("", "firing", "firing", 2)},
    4: {("a", "firing", "normal", None), ("b", "normal", "pending", 4), ("", "firing", "normal", None)},
}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def job(spark, store):
    return Alerting(store, Feed(spark, SLOW, {2: None, 3: 0}), 60, RULES)


def history(store):
    out = {}
    for r in store.read("alerts").collect():
        label = r.labels.split('"')[3] if r.rule == "slow" else ""
        since = None if r.since is None else int((r.since - at(0)).total_seconds()) // 60
        rows = out.setdefault(int((r.evaluated_at - at(0)).total_seconds()) // 60, [])
        rows.append((label, r.previous, r.state, since))
    assert all(len(rows) == len(set(rows)) for rows in out.values())
    return {k: set(rows) for k, rows in out.items()}


def test_state_is_carried_from_tick_to_tick(store, job):
    for minute in range(5):
        assert job.tick(at(60 * minute))
        assert not job.tick(at(60 * minute))
    assert history(store) == STATES
    raised = {(r.rule, r.severity, r.value) for r in job.raised(at(0)).collect()}
    assert raised == {("slow", "critical", 22.0), ("slow", "critical", 13.0), ("quiet", "warning", None)}


@pytest.mark.parametrize("written", [False, True])
def test_a_restart_neither_loses_nor_doubles_a_firing(spark, store, job, monkeypatch, written):
    for minute in range(5):
        if minute in (2, 3):
            with monkeypatch.context() as broken:
                if written:
                    note = Store.note
                    broken.setattr(Store, "note", lambda self, *a: note(self, *a) if a[3] == "planned" else 1 / 0)
                else:
                    broken.setattr(Store, "write", lambda *a: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    job.tick(at(60 * minute))
            job = Alerting(Store(spark, store.root), job.results, 60, RULES)
            assert not job.tick(at(60 * minute))  # done again while starting
        else:
            job.tick(at(60 * minute))
    assert history(store) == STATES


def test_a_gap_starts_anew_and_quiet_ticks_write_nothing(spark, store):
    job = Alerting(store, Feed(spark, {0: [("b", 20)], 9: [("b", 20)], 10: []}, {}), 60, RULES)
    for minute in (0, 9, 10, 11):
        job.tick(at(60 * minute))
    assert history(store) == {0: {("b", "normal", "pending", 0)}, 9: {("b", "pending", "pending", 9)},
                              10: {("b", "pending", "normal", None)}}
    store.compact("alerts", at(0).date(), jobs.MERGES["alerts"])
    assert len(history(store)) == 3
    store.note(ALERTING, 0, Planned("x", at(0), at(1), at(9)), "planned", at(1))
    with pytest.raises(RuntimeError):
        store.compact("alerts", at(0).date(), jobs.MERGES["alerts"])
    store.compact("sessions", at(0).date(), lambda rows: rows)  # not this job's table


def test_all_rules_on_an_empty_store_and_from_the_command_line(spark, tmp_path, monkeypatch):
    folder, root = tmp_path / "csv", str(tmp_path / "root")
    for name, df in inventory_tables(spark).items():
        df.coalesce(1).write.csv(str(folder / f"{name}.csv"), header=True)
    jobs.main(["--root", root, "load-inventory", "--folder", str(folder)], spark)
    for minute in (0, 2, 4):
        monkeypatch.setattr(jobs, "utc_now", lambda m=minute: at(60 * m))
        assert jobs.main(["--root", root, "alert", "--once"], spark)
    states = {r.rule: r.state for r in Store(spark, root).read("alerts", at(0)).filter(
        f"evaluated_at = timestamp'{at(240)}'").collect()}
    assert states == {"stitch_lag": "firing", "ingest_stopped": "firing"}
    assert timedelta(seconds=alerts.RULES["stitch_lag"].hold_s) <= timedelta(minutes=4)
