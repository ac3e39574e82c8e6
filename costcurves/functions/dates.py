"""Day arithmetic on timestamp_ntz values (time of day is kept)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from start to end, plus one (inclusive day count).

    ``end - start`` on timestamp_ntz is a day-time interval (no time zone
    involved); its DAY field floors elapsed time like ``timedelta.days``,
    where a calendar ``datediff`` would count 18:00 -> 06:00 two days later
    as 2. For start <= end.
    """
    return F.extract(F.lit("DAY"), end - start).cast("long") + 1


def add_days(ts: Column, days: Column) -> Column:
    """``ts + days`` keeping the time of day (interval arithmetic, zone-free)."""
    return ts + F.make_dt_interval(days=days.cast("int"))


def as_of_date(as_of=None) -> Column:
    """The as-of day as a date: a date, datetime, ISO string or Column; today when None."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(str(as_of)).cast("date")


def as_of_midnight(as_of=None) -> Column:
    """Midnight of the as-of day as timestamp_ntz (``DATE > as_of`` keeps 08:00 today)."""
    return as_of_date(as_of).cast("timestamp_ntz")
