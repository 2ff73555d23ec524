"""Parquet tables written batch by batch, safe to repeat.

Layout: <root>/<table>/day=<date>/batch_id=<id>/. A batch owns its own directories, so
doing it again replaces what it wrote and nothing else; a reader that knows its time range
lists only the days it needs. One job writes a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import instant, micros_of
from ..operators.keyed import latest_per_key
from ..settings import RETENTION_DAYS
from . import schemas
from .files import delete, exists, join, matching

TABLES = {
    "halfflows": schemas.HALFFLOWS,
    "queue": schemas.QUEUE,
    "ingest_errors": schemas.INGEST_ERRORS,
    "fault_events": schemas.FAULT_EVENTS,
    "sessions": schemas.SESSIONS,
    "quality_1m": schemas.QUALITY_1M,
    "element_1m": schemas.ELEMENT_1M,
    "alerts": schemas.ALERTS,
}

# Which day a row belongs to, and the order inside a file that makes min/max statistics
# of row groups selective for the table's readers.
DAY_OF = {
    "halfflows": "first_seen",
    "queue": "ingested_at",
    "ingest_errors": "received_at",
    "fault_events": "event_at",
    "sessions": "session_start",
    "quality_1m": "minute",
    "element_1m": "minute",
    "alerts": "evaluated_at",
}
SORT = {
    "halfflows": ("first_seen", "community_id"),
    "queue": ("ingested_at", "community_id"),
    "ingest_errors": ("received_at",),
    "fault_events": ("fault_id",),
    "sessions": ("branch_id", "session_start", "community_id"),
    "quality_1m": ("minute", "branch_id", "app", "circuit_id"),
    "element_1m": ("element_type", "element_id", "minute"),
    "alerts": ("evaluated_at", "rule", "labels"),
}
# Columns looked up by value: a bloom filter lets a reader skip row groups.
BLOOM = {"sessions": ("community_id",)}


INGESTED = ("halfflows", "queue", "ingest_errors", "fault_events")  # written by ingest jobs
INGEST = "ingest-"  # what the names of ingest jobs in the journal begin with
ALERTING = "alerts"  # the job that writes the table of this name


@dataclass(frozen=True)
class Planned:
    """A window as written to the journal."""

    batch_id: str
    lo: datetime
    hi: datetime
    live_from: datetime


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    # --- batches ----------------------------------------------------------------

    def write(self, table: str, rows: DataFrame, batch_id: str) -> None:
        placed = rows.select(
            *[c.split()[0] for c in TABLES[table].split(",")],
            F.to_date(DAY_OF[table]).alias("day"),
            F.lit(batch_id).alias("batch_id"),
        )
        writer = (
            # the directory columns lead, or the writer would sort again and lose the rest
            placed.sortWithinPartitions("day", "batch_id", *SORT[table])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
        )
        for column in BLOOM.get(table, ()):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.partitionBy("day", "batch_id").parquet(join(self.root, table))

    def discard(self, table: str, batch_id: str) -> None:
        """Remove what an unfinished attempt of this batch left behind."""
        for path in matching(self.spark, join(self.root, table, "day=*", f"batch_id={batch_id}")):
            delete(self.spark, path)

    def read(
        self, table: str, since: datetime | None = None, batch_id: str | None = None
    ) -> DataFrame:
        """The table from `since`'s day on; only those days are listed."""
        ddl = f"{TABLES[table]}, day date, batch_id string"
        paths = [
            p
            for p in matching(self.spark, join(self.root, table, "day=*"))
            if since is None or _day(p) >= since.date()
        ]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        rows = (
            self.spark.read.schema(ddl).option("basePath", join(self.root, table)).parquet(*paths)
        )
        if batch_id is not None:
            return rows.filter(F.col("batch_id") == batch_id)
        return self._without_superseded(table, rows)

    # --- journal and watermark --------------------------------------------------

    def _journal(self, job: str = "*", shard: int | str = "*") -> DataFrame:
        """The newest entry per job and shard. Two slots are written in turn, so a crash
        while writing one leaves the other, and the journal never grows."""
        slots = matching(self.spark, join(self.root, "journal", job, str(shard), "slot-*"))
        if not slots:
            return self.spark.createDataFrame([], schemas.JOURNAL)
        rows = self.spark.read.schema(schemas.JOURNAL).parquet(*slots)
        return latest_per_key(rows, ["job", "shard"], ["seq"])

    def note(self, job: str, shard: int, plan: Planned, state: str, at: datetime) -> None:
        last = self._journal(job, shard).first()
        seq = last["seq"] + 1 if last else 0
        row = self.spark.range(1).select(
            F.lit(seq).cast("bigint").alias("seq"),
            F.lit(job).alias("job"),
            F.lit(shard).cast("int").alias("shard"),
            F.lit(plan.batch_id).alias("batch_id"),
            instant(plan.lo).alias("lo"),
            instant(plan.hi).alias("hi"),
            instant(plan.live_from).alias("live_from"),
            F.lit(state).alias("state"),
            instant(at).alias("updated_at"),
        )
        slot = join(self.root, "journal", job, str(shard), f"slot-{seq % 2}")
        row.coalesce(1).write.mode("overwrite").parquet(slot)

    def watermarks(self) -> DataFrame:
        """How far every job has got: (job, shard, watermark, updated_at). A window that is
        planned but not done has got as far as its start."""
        reached = F.when(F.col("state") == "done", F.col("hi")).otherwise(F.col("lo"))
        return self._journal().filter(~F.col("job").startswith(INGEST)).select("job", "shard", reached.alias("watermark"), "updated_at")

    def watermark(self, job: str, shard: int = 0) -> datetime | None:
        row = self._journal(job, shard).first()
        return None if row is None else row["hi"] if row["state"] == "done" else row["lo"]

    def unfinished(self, job: str, shard: int = 0) -> Planned | None:
        """The planned window whose batch never finished, if any."""
        row = self._journal(job, shard).first()
        return None if row is None or row["state"] == "done" else _planned(row)

    def newest(self, job: str, shard: int = 0) -> Planned | None:
        """The batch a job noted last, finished or not."""
        row = self._journal(job, shard).first()
        return None if row is None else _planned(row)

    def arriving_since(self) -> datetime | None:
        """The earliest arrival time of the ingest batches that are still being written."""
        open_ = self._journal(f"{INGEST}*").filter("state <> 'done'")
        return open_.agg(F.min("lo")).first()[0]

    # --- compaction and retention -----------------------------------------------

    def _compactions(self, table: str) -> list:
        """Where each compacted day's valid batches begin; one row per retained day."""
        path = join(self.root, "compactions")
        if not exists(self.spark, path):
            return []
        rows = self.spark.read.schema(schemas.COMPACTIONS).parquet(path)
        newest = rows.filter(F.col("table_name") == table).groupBy("day")
        return newest.agg(F.max("from_batch").alias("from_batch")).collect()

    def _without_superseded(self, table: str, rows: DataFrame) -> DataFrame:
        merged = self._compactions(table)
        if not merged:
            return rows
        pairs = [x for r in merged for x in (F.lit(r["day"]), F.lit(r["from_batch"]))]
        first = F.coalesce(F.create_map(*pairs)[F.col("day")], F.lit(""))
        return rows.filter(F.col("batch_id") >= first)

    def compact(self, table: str, day: date, merge) -> None:
        """Merge a closed day's batches into one. `merge` turns partial rows into final
        ones. Run it between ticks; later batches for the day simply add to it.

        The merged batch sorts right after the newest one it replaces, so it can hide
        neither a later batch nor, as none may be unfinished, one still to be redone.
        """
        ingests, alerts = F.col("job").startswith(INGEST), F.col("job") == ALERTING
        writers = ingests if table in INGESTED else alerts if table == ALERTING else ~(ingests | alerts)
        if not self._journal().filter(writers & (F.col("state") != "done")).isEmpty():
            raise RuntimeError("a planned batch is not finished; let its job repair it first")
        partial = self.read(table).filter(F.col("day") == F.lit(day))
        newest = partial.agg(F.max("batch_id")).first()[0]
        if newest is None:
            return
        batch_id = f"{newest}~compact"
        self.write(table, merge(partial), batch_id)
        done = self.spark.range(1).select(
            F.lit(table).alias("table_name"), F.lit(day).alias("day"),
            F.lit(batch_id).alias("from_batch"),
        )
        done.coalesce(1).write.mode("append").parquet(join(self.root, "compactions"))

    def vacuum(self, table: str) -> int:
        """Delete batches a compaction has replaced. A reader that began before the compaction
        may still read them: vacuum what an earlier round of maintenance has compacted."""
        gone = 0
        for row in self._compactions(table):
            day = join(self.root, table, f"day={row['day']}", "batch_id=*")
            for path in matching(self.spark, day):
                if path.rsplit("batch_id=", 1)[1] < row["from_batch"]:
                    gone += delete(self.spark, path)
        return gone

    def expire(
        self, today: date, days: dict[str, int] = RETENTION_DAYS, tables: Sequence[str] = ()
    ) -> list[str]:
        """Drop whole days past their retention; no file is rewritten."""
        dropped = []
        for table in tables or days:
            oldest = today - timedelta(days=days[table])
            for path in matching(self.spark, join(self.root, table, "day=*")):
                if _day(path) < oldest:
                    delete(self.spark, path)
                    dropped.append(path)
        return dropped


def _planned(row: Row) -> Planned:
    return Planned(row["batch_id"], row["lo"], row["hi"], row["live_from"])


def _day(path: str) -> date:
    return date.fromisoformat(path.rsplit("day=", 1)[1].split("/")[0])


def batch_name(created: datetime, kind: str) -> str:
    """Sorts by creation time."""
    return f"{micros_of(created) // 1000:015d}-{kind}"


def retained(rows: DataFrame, time_column: str, now: datetime, days: int) -> DataFrame:
    """What retention leaves at `now`: the same rule as a predicate, on whole days."""
    oldest = micros_of(now) // 86_400_000_000 - days
    return rows.filter(F.to_date(time_column) >= F.date_from_unix_date(F.lit(oldest)))
