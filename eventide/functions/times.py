"""Event-time helpers. Bounds are epoch milliseconds, so no zone is involved."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def millis(duration: timedelta) -> int:
    """Whole milliseconds of a duration."""
    return duration // timedelta(milliseconds=1)


def interval_text(duration: timedelta) -> str:
    """A duration in the form ``withWatermark`` and ``window`` take."""
    return f"{millis(duration)} milliseconds"


def floor_to(ms: Column, step: timedelta) -> Column:
    """Largest multiple of ``step`` not after ``ms``, also before 1970."""
    step_ms = F.lit(millis(step))
    return ms - F.pmod(ms, step_ms)


def timestamp_text(ms: Column) -> Column:
    """``2017-11-26 09:05:00.0``: whole seconds with one fraction digit, in the session zone."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.S")


def utc_day(ts: Column) -> Column:
    """Number of the UTC day since 1970."""
    return F.floor(F.unix_seconds(ts) / DAY_SECONDS).cast("long")


def next_utc_midnight(ts: Column) -> Column:
    """Start of the following UTC day, whatever the session zone."""
    return F.timestamp_seconds((utc_day(ts) + 1) * DAY_SECONDS)


def access_log_time(token: Column) -> Column:
    """``17/05/2015:10:05:03`` in the session zone; null if it is no time at all.

    Fields out of range roll over (day 32 of January is the first of February),
    as in a lenient calendar. Well-formed tokens take the direct path and the
    arithmetic runs on the others only.
    """
    part = F.split(token, "[/:]")
    number = [F.get(part, F.lit(i)).try_cast("int") for i in range(6)]
    day, month, year, hour, minute, second = number
    month_start = F.add_months(
        F.when(year.between(1, 9999), F.make_date(year, F.lit(1), F.lit(1))), month - 1
    )
    rolled = F.date_add(month_start, day - 1).cast("timestamp") + F.make_dt_interval(
        F.lit(0), hour, minute, second.cast("decimal(18,6)")
    )
    return F.coalesce(F.try_to_timestamp(token, F.lit("dd/MM/yyyy:HH:mm:ss")), rolled)
