"""Ingest, stitching in ticks, crashes, repairs, compaction and retention on real files."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pathquality.plans.rollup import merge_element, merge_quality
from pathquality.settings import StitchSettings
from pathquality.sources import inventory as inv
from pathquality.sources.files import delete
from pathquality.sources.store import Planned, Store, retained
from pathquality.sources.wire import queue_rows
from pathquality.streaming import stitcher as stitcher_module
from pathquality.streaming.ingest import (
    file_messages,
    ingest_batch,
    ingest_fault_batch,
    start_ingest,
)
from pathquality.streaming.stitcher import JOB, REPAIR, Stitcher

from .network import T0, at, halfflows, inventory_tables, record, us


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def lookups(spark):
    return inv.lookups(inventory_tables(spark))


def message(cid, direction, first, **over):
    way = "c" if direction == "c2s" else "s"
    body = {
        "record_id": f"{cid}{way}{int(first * 1000)}".rjust(16, "0")[-16:], "community_id": cid,
        "direction": direction, "first_seen_us": us(first), "flow_end_us": us(first + 1),
        "is_final": 1, "src_ip": "10.1.0.20", "dst_ip": "10.200.1.10", "ip_proto": 17,
        "tunnel_id": 11, "app": "pay", "bytes": 10, "packets": 5,
    }
    return json.dumps({**body, **over})


def fill(store, rows, batch="000000000000001-flows"):
    flows = halfflows(store.spark, rows)
    store.write("halfflows", flows, batch)
    store.write("queue", queue_rows(flows), batch)


def both(cid, first, **over):
    return [record(cid, "c2s", first, **over), record(cid, "s2c", first + 0.01, **over)]


def test_stream_splits_good_from_bad_and_restarts_cleanly(spark, store, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        q = start_ingest(store, file_messages(spark, str(inbox)), checkpoint, every=None,
                         clock=lambda: at(10))
        assert q.awaitTermination(120)

    (inbox / "1.txt").write_text("\n".join(
        [message("a", "c2s", 0), message("a", "s2c", 0.01), "{broken", message("a", "up", 1)]) + "\n")
    run()
    (inbox / "2.txt").write_text(message("b", "c2s", 2) + "\n")
    run()
    run()  # nothing new
    assert store.read("halfflows").count() == 3
    assert store.read("queue").select("community_id").distinct().count() == 2
    errors = {r["error"] for r in store.read("ingest_errors").collect()}
    assert errors == {"unparsable message", "invalid direction"}
    assert store.read("halfflows").filter(F.col("ingested_at") != F.lit(at(10))).count() == 0


def test_repeating_an_ingest_batch_replaces_it(spark, store):
    messages = spark.createDataFrame([(message("a", "c2s", 0),), ("{broken",)], "value string")
    for now in (at(10), at(400_000)):  # the second try is hours later, another arrival day
        ingest_batch(store, messages, 7, lambda now=now: now)
    assert store.read("halfflows").count() == store.read("queue").count() == 1
    assert store.read("ingest_errors").count() == 1


def test_a_replayed_batch_keeps_its_first_arrival_time(spark, store):
    messages = spark.createDataFrame([(message("a", "c2s", 0),)], "value string")
    ingest_batch(store, messages, 7, lambda: at(10))
    ingest_batch(store, messages, 7, lambda: at(5000))
    assert [r["ingested_at"] for r in store.read("queue").collect()] == [at(10)]
    ingest_batch(store, messages, 8, lambda: at(5000))
    assert store.read("queue").agg(F.max("ingested_at")).first()[0] == at(5000)


def test_a_batch_that_becomes_visible_late_is_stitched(spark, store, lookups):
    """Its rows are stamped at 60 s and written when stitching would long have passed them."""
    worker = Stitcher(store, lambda: lookups, StitchSettings(max_window_s=10_000))
    fill(store, both("early", 0))
    assert worker.catch_up(at(30)) == 1
    rows = [(message("late", "c2s", 55),), (message("late", "s2c", 55.01),)]
    seen = []

    class Slow(Store):
        def write(self, table, df, batch_id):
            seen.append(worker.catch_up(at(1000)))  # while the batch is being written
            super().write(table, df, batch_id)

    ingest_batch(Slow(spark, store.root), spark.createDataFrame(rows, "value string"), 0, lambda: at(60))
    assert seen == [0, 0, 0] and store.watermark(JOB) < at(60)
    assert worker.catch_up(at(1001)) == 1
    assert store.read("sessions").filter("community_id = 'late'").count() == 1
    assert store.watermark(JOB) == at(991)


def test_a_new_checkpoint_keeps_old_rows(spark, store, tmp_path):
    for turn, cid in enumerate("ab"):
        inbox = tmp_path / f"inbox{turn}"
        inbox.mkdir()
        (inbox / "1.txt").write_text(message(cid, "c2s", turn) + "\n")
        query = start_ingest(store, file_messages(spark, str(inbox)), str(tmp_path / f"checkpoint{turn}"),
                             every=None, clock=lambda: at(10))
        assert query.awaitTermination(120)
    assert {r["community_id"] for r in store.read("halfflows").collect()} == {"a", "b"}


def test_fault_batches(spark, store):
    rows = [(json.dumps({"fault_id": "f", "state": s, "event_at_us": us(0)}),) for s in
            ("started", "ended", "odd")]
    ingest_fault_batch(store, spark.createDataFrame(rows, "value string"), 0, lambda: at(1))
    assert store.read("fault_events").count() == 2 and store.read("ingest_errors").count() == 1


def test_ticks_emit_every_session_once(store, lookups):
    rows = both("a", 0) + both("b", 30) + [record("c", "c2s", 40, final=False)]
    fill(store, rows)
    worker = Stitcher(store, lambda: lookups, StitchSettings(max_window_s=500))
    assert worker.catch_up(at(100)) == 2
    assert worker.catch_up(at(200)) == 0
    assert worker.catch_up(at(2000)) == 1  # c went idle
    sessions = store.read("sessions")
    assert sessions.count() == sessions.select("community_id", "session_start").distinct().count() == 3
    assert store.read("quality_1m").agg(F.sum("sessions")).first()[0] == 3
    apps = store.read("element_1m").filter("element_type = 'app'")
    assert apps.agg(F.sum("sessions")).first()[0] == 3
    assert store.watermark(JOB) == at(1990)


def test_late_reply_is_found_by_a_recheck(store, lookups):
    worker = Stitcher(store, lambda: lookups)
    request, reply = both("a", 0)
    fill(store, [request])
    assert worker.catch_up(at(30)) == 0
    reply["ingested_at"] = at(10)  # arrived, but not visible when its window was read
    fill(store, [reply], "000000000000002-flows")
    assert worker.catch_up(at(120)) == 1
    assert store.read("sessions").first()["complete"]


@pytest.mark.parametrize("broken", ["quality_1m", "element_1m"])
def test_crash_between_tables_is_repaired(store, lookups, monkeypatch, broken):
    fill(store, both("a", 0) + both("b", 1))
    worker = Stitcher(store, lambda: lookups)
    with monkeypatch.context() as m:
        def fail(*_):
            raise RuntimeError("executor gone")
        m.setattr(stitcher_module, broken, fail)
        with pytest.raises(RuntimeError):
            worker.tick(at(60))
    planned = store.unfinished(JOB)
    assert planned is not None and store.watermark(JOB) == planned.lo
    fill(store, both("late", 2), "000000000000002-flows")
    worker.catch_up(at(300))
    assert store.unfinished(JOB) is None
    for table, condition in (("sessions", "true"), ("quality_1m", "true"),
                             ("element_1m", "element_type = 'app'")):
        rows = store.read(table).filter(condition)
        total = rows.count() if table == "sessions" else rows.agg(F.sum("sessions")).first()[0]
        assert total == 3, table


def test_restitch_fills_gaps_only(store, lookups):
    fill(store, both("a", 0) + both("b", 30) + both("busy", 40))
    worker = Stitcher(store, lambda: lookups, StitchSettings(max_window_s=1000))
    worker.catch_up(at(3000))
    mark = store.watermark(JOB)
    for batch in {r["batch_id"] for r in store.read("sessions").select("batch_id").collect()}:
        for table in ("sessions", "quality_1m", "element_1m"):
            store.discard(table, batch)
    again = record("busy", "c2s", 40, seq=1, ingested_at=at(2500))
    fill(store, [again], "000000000000003-flows")
    assert worker.restitch(at(-10), at(5000), at(3001)) == 2  # busy still belongs to live
    assert worker.restitch(at(-10), at(5000), at(3002)) == 0
    assert store.watermark(JOB) == mark and store.unfinished(REPAIR) is None
    assert {r["community_id"] for r in store.read("sessions").collect()} == {"a", "b"}
    assert store.read("quality_1m").agg(F.sum("sessions")).first()[0] == 2


def test_first_run_on_an_empty_queue_starts_now(store, lookups):
    worker = Stitcher(store, lambda: lookups)
    assert worker.tick(at(0)) == (0, False)
    assert worker._watermark(at(0)) == at(0)


def test_compaction_keeps_totals_and_accepts_later_batches(store, lookups):
    fill(store, both("a", 0) + both("b", 1))
    worker = Stitcher(store, lambda: lookups)
    worker.catch_up(at(60))
    day = at(0).date()

    def totals():
        q = store.read("quality_1m")
        e = store.read("element_1m").filter("element_type = 'app'")
        return (q.agg(F.sum("sessions")).first()[0], e.agg(F.sum("sessions")).first()[0],
                store.read("quality_1m").count())

    fill(store, both("c", 100), "000000000000002-flows")
    worker.catch_up(at(200))
    assert totals() == (3, 3, 2)
    for table, merge in (("quality_1m", merge_quality), ("element_1m", merge_element)):
        store.compact(table, day, merge)
    assert totals()[:2] == (3, 3)
    left = {r["batch_id"] for r in store.read("quality_1m").select("batch_id").collect()}
    assert len(left) == 1 and left.pop().endswith("~compact")
    assert store.vacuum("quality_1m") > 0 and totals()[:2] == (3, 3)
    store.note(REPAIR, 0, Planned("x", at(0), at(1), at(2)), "planned", at(250))
    with pytest.raises(RuntimeError, match="not finished"):
        store.compact("quality_1m", day, merge_quality)
    fill(store, both("d", 400), "000000000000003-flows")
    worker.catch_up(at(600))
    assert totals()[:2] == (4, 4)


def test_a_compacted_day_is_few_files_and_stitches_alike(store, lookups):
    from pathquality.__main__ import MERGES
    from pathquality.sources.files import matching

    for i in range(20):
        fill(store, both(f"c{i}", i), f"{i:015d}-flows")
    worker = Stitcher(store, lambda: lookups, StitchSettings(max_window_s=500))
    before = store.read("halfflows"), store.read("queue")  # readers that began before
    counts = [df.count() for df in before]
    for table in ("halfflows", "queue"):
        store.compact(table, T0.date(), MERGES[table])
    assert [df.count() for df in before] == counts
    assert worker.catch_up(at(100)) == 20 and store.read("halfflows").count() == counts[0]
    store.compact("sessions", T0.date(), MERGES["sessions"])
    for table in ("halfflows", "queue", "sessions"):
        store.vacuum(table)
        assert len(matching(store.spark, f"{store.root}/{table}/day=*/batch_id=*")) == 1
        assert len(matching(store.spark, f"{store.root}/{table}/day=*/batch_id=*/*.parquet")) <= 2
    assert worker.catch_up(at(2000)) == 0 and store.read("sessions").count() == 20
    fill(store, both("late", 1900, ingested_at=at(2000)), "000000000000999-flows")
    assert worker.catch_up(at(2100)) == 1


def test_an_open_batch_forbids_compaction(spark, store):
    store.note("ingest-x", 0, Planned("b", at(0), at(0), at(0)), "planned", at(0))
    fill(store, both("a", 0))
    with pytest.raises(RuntimeError):
        store.compact("halfflows", T0.date(), lambda rows: rows)


def test_retention_drops_whole_days(spark, store):
    for days in (0, 3, 9):
        first = -days * 86_400.0
        fill(store, both("a", first), f"{days:015d}-flows")
    today = at(0).date()
    dropped = store.expire(today, tables=["halfflows", "queue"])
    assert len(dropped) == 3  # halfflows: 9 days; queue: 9 and 3 days
    left = {r["day"] for r in store.read("halfflows").select("day").collect()}
    assert left == {today, today - timedelta(days=3)}
    kept = retained(store.read("halfflows"), "first_seen", at(0), 2)
    assert {r["day"] for r in kept.select("day").collect()} == {today}


def test_reading_from_a_day_lists_only_later_ones(store):
    for days in (0, 3):
        fill(store, both("a", -days * 86_400.0), f"{days:015d}-flows")
    files = store.read("halfflows", at(-86_400)).inputFiles()
    assert files and all("day=2026-03-02" in f for f in files)
    assert date(2026, 3, 2) == at(0).date()


def test_journal_returns_the_planned_window(store):
    plan = Planned("b1", at(0), at(120), at(9999))
    store.note(JOB, 0, plan, "planned", at(1))
    assert store.unfinished(JOB) == plan and store.unfinished(REPAIR) is None
    store.note(JOB, 0, plan, "done", at(2))
    assert store.unfinished(JOB) is None and store.watermark(JOB) == at(120)


def test_losing_a_journal_slot_loses_no_ground(store):
    first, second = Planned("b1", at(0), at(120), at(9999)), Planned("b2", at(120), at(240), at(9999))
    for plan, state in ((first, "planned"), (first, "done"), (second, "planned"), (second, "done")):
        store.note(JOB, 0, plan, state, at(1))
    store.note("other", 3, first, "done", at(1))
    delete(store.spark, f"{store.root}/journal/{JOB}/0/slot-1")  # crashed while noting "done"
    assert store.unfinished(JOB) == second and store.watermark(JOB) == at(120)
    store.note(JOB, 0, second, "done", at(2))
    assert store.watermark(JOB) == at(240)
    assert {(r["job"], r["shard"]) for r in store.watermarks().collect()} == {(JOB, 0), ("other", 3)}


def test_jobs_from_the_command_line(spark, tmp_path, monkeypatch):
    from pathquality import __main__ as jobs

    folder, root = tmp_path / "csv", str(tmp_path / "root")
    for name, df in inventory_tables(spark).items():
        df.coalesce(1).write.csv(str(folder / f"{name}.csv"), header=True)
    counts = jobs.main(["--root", root, "load-inventory", "--folder", str(folder)], spark)
    assert counts["branches"] == 1
    store = Store(spark, root)
    fill(store, both("a", 0) + both("b", 30))
    monkeypatch.setattr(jobs, "utc_now", lambda: at(4000))
    store.note(JOB, 0, Planned("x", at(0), at(3000), at(9999)), "done", at(3000))
    span = ["--since", at(-10).isoformat(), "--until", at(110).isoformat()]
    assert jobs.main(["--root", root, "restitch", *span], spark) == 2
    inbox = tmp_path / "faults"
    inbox.mkdir()
    fault = {"fault_id": "f", "state": "started", "event_at_us": us(0)}
    (inbox / "1.txt").write_text(json.dumps(fault) + "\n")
    for _ in range(2):
        jobs.main(["--root", root, "ingest-faults", "--files", str(inbox), "--once"], spark)
    assert store.read("fault_events").count() == 1
    monkeypatch.setattr(jobs, "utc_now", lambda: at(86_400))
    assert jobs.main(["--root", root, "maintain"], spark) == []
    assert store.read("quality_1m").agg(F.sum("sessions")).first()[0] == 2
