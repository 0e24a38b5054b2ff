"""Time helpers.  The session time zone is pinned to UTC; instants are
stored in UTC and converted to a display zone only on output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_local(ts: Column, tz: str = "Europe/London") -> Column:
    """UTC wall-clock timestamp -> wall-clock time in ``tz``."""
    return F.from_utc_timestamp(ts.cast("timestamp"), tz)


def unix_seconds(ts: Column) -> Column:
    """Timestamp (UTC) -> seconds since the epoch."""
    return F.unix_seconds(ts.cast("timestamp"))


def plus_days(ts: Column, days: int) -> Column:
    """``ts + INTERVAL days DAYS``."""
    return ts + F.make_dt_interval(F.lit(days))


def unix_seconds_of_wall_clock(ts_ntz: Column) -> Column:
    """Seconds since the epoch of a UTC wall-clock ``TIMESTAMP_NTZ`` value,
    computed from its fields, so the result never depends on the session
    time zone (a cast to ``TIMESTAMP`` would read the wall clock in it)."""
    days = F.datediff(F.to_date(ts_ntz), F.to_date(F.lit("1970-01-01")))
    return (
        days.cast("long") * 86400
        + F.hour(ts_ntz).cast("long") * 3600
        + F.minute(ts_ntz).cast("long") * 60
        + F.second(ts_ntz).cast("long")
    )
