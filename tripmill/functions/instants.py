"""Time without zones. Every expression here is independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(ts: Column) -> Column:
    """Seconds since 1970 as a double; grows with ``ts``, so it may be used to slice time."""
    return (
        F.unix_date(ts.cast("date")).cast("double") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.date_part(F.lit("SECOND"), ts).cast("double")
    )


def micros(ts: Column) -> Column:
    """Microseconds since 1970, exactly."""
    whole = F.unix_date(ts.cast("date")).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return whole * 1_000_000 + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def hour_trunc(ts: Column) -> Column:
    return ts - F.make_dt_interval(mins=F.minute(ts), secs=F.date_part(F.lit("SECOND"), ts))


def start_hour(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1


def month_of(ts: Column) -> Column:
    return F.month(ts)


def distance(a: Column, b: Column) -> Column:
    """Absolute difference as a day-time interval, exact to the microsecond."""
    return F.abs(a - b)


def epoch_diff(a: Column, b: Column) -> Column:
    """Absolute difference in seconds."""
    gap = distance(a, b)
    return (
        F.date_part(F.lit("DAY"), gap).cast("double") * 86400
        + F.date_part(F.lit("HOUR"), gap) * 3600
        + F.date_part(F.lit("MINUTE"), gap) * 60
        + F.date_part(F.lit("SECOND"), gap).cast("double")
    )


def date_from_iso(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date")


def before(ts: Column, secs: str) -> Column:
    """``ts`` moved back by a literal number of seconds."""
    return ts - F.make_dt_interval(secs=F.lit(secs).cast("decimal(18,6)"))


def after(ts: Column, secs: str) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(secs).cast("decimal(18,6)"))


def as_ntz(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")
