"""Time predicates. `now` is always a parameter so that a run can be repeated."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
FAR_FUTURE = datetime(2200, 1, 1)


def naive_utc(moment: datetime) -> datetime:
    """Aware datetimes are converted to UTC, naive ones are taken as UTC."""
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def micros_of(moment: datetime) -> int:
    return (naive_utc(moment) - EPOCH) // timedelta(microseconds=1)


def instant(moment: datetime) -> Column:
    """A timestamp literal that does not depend on the machine's time zone."""
    return F.timestamp_micros(F.lit(micros_of(moment)))


def floor_minute(moment: datetime) -> datetime:
    return naive_utc(moment).replace(second=0, microsecond=0)


def millis_between(earlier: Column, later: Column) -> Column:
    """Difference counted in crossed millisecond boundaries."""
    return F.unix_millis(later) - F.unix_millis(earlier)


def complete(minute: Column, now: datetime) -> Column:
    """The minute still being filled is left out."""
    return minute < instant(floor_minute(now))


def last_minutes(minute: Column, now: datetime, count: int) -> Column:
    """The last `count` complete minutes: [from, current minute)."""
    start = floor_minute(now) - timedelta(minutes=count)
    return (minute >= instant(start)) & complete(minute, now)


def between(moment: Column, start: datetime, end: datetime) -> Column:
    """Closed range, as a dashboard's time picker selects it."""
    return (moment >= instant(start)) & (moment <= instant(end))
