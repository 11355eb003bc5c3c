"""Time columns: bucket floors, clock phases, sessions, epoch units, windows of days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORIGIN = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end, with fractions."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(1e6)


def shift(ts: Column | str, seconds: Column | int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds) if isinstance(seconds, int) else seconds, col(ts))


def floor_to(ts: Column | str, seconds: int) -> Column:
    """Start of the bucket of ``seconds`` seconds, counted from 1970; the type of a zoneless timestamp is kept."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(ORIGIN), col(ts))
    return F.timestamp_add("SECOND", F.floor(micros / F.lit(seconds * 1_000_000)) * seconds, F.expr(ORIGIN))


def clock_phase(ts: Column | str, minutes: int = 15) -> Column:
    """Number of the clock slot within the day (0 to 95 for quarters of an hour)."""
    return ((F.hour(col(ts)) * 60 + F.minute(col(ts))) / minutes).cast("int")


def minute_of_day(ts: Column | str) -> Column:
    return F.hour(col(ts)) * 60 + F.minute(col(ts))


def in_session(ts: Column | str, first: int, last: int, zone: str | None = None, closed: bool = False) -> Column:
    """Monday to Friday and minute of the day in [first, last), or [first, last] if closed; ``zone`` turns UTC into local time first."""
    local = col(ts)
    if zone:
        local = F.from_utc_timestamp(local.cast("timestamp"), zone)
    minute = minute_of_day(local)
    end = minute <= last if closed else minute < last
    return F.weekday(local).between(0, 4) & (minute >= first) & end


def from_epoch(value: Column | str) -> Column:
    """Timestamp of an epoch number in seconds, milli-, micro- or nanoseconds, told by its magnitude."""
    v = col(value).cast("long")
    size = F.abs(v)
    micros = (
        F.when(size < 100_000_000_000, v * 1_000_000)
        .when(size < 100_000_000_000_000, v * 1000)
        .when(size < 100_000_000_000_000_000, v)
        .otherwise(F.floor(v.cast("decimal(20,0)") / 1000).cast("long"))
    )
    return F.timestamp_add("MICROSECOND", micros, F.expr(ORIGIN))
