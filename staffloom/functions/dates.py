"""Date arithmetic. The clock is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Clock = Column | dt.date | dt.datetime | str | None


def _literal(moment: Clock) -> Column:
    # As text: a Python datetime would be shifted by the driver's time zone.
    return moment if isinstance(moment, Column) else F.lit(str(moment))


def today(as_of: Clock = None) -> Column:
    """`as_of` as a date column; the date of `now` when not given."""
    return now().cast("date") if as_of is None else _literal(as_of).cast("date")


def now(as_of_ts: Clock = None) -> Column:
    """`as_of_ts` as a zone-free timestamp; the current one in UTC when not given.

    Loads stamp their rows in UTC, so reports must count back from UTC as well, in
    whatever time zone their session is.
    """
    if as_of_ts is None:
        return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    return _literal(as_of_ts).cast("timestamp_ntz")


def complete_months(start: Column, end: Column) -> Column:
    """Whole months from one date to another, negative when `end` is earlier.

    Calendar arithmetic, so that no session time zone with a missing midnight can
    take a month off.
    """
    apart = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    overshoot = F.sign(F.day(end) - F.day(start)).cast("int")
    return (
        F.when((apart > 0) & (overshoot < 0), apart - 1)
        .when((apart < 0) & (overshoot > 0), apart + 1)
        .otherwise(apart)
    )


def complete_years(start: Column, end: Column) -> Column:
    return (complete_months(start, end) / 12).cast("int")


def calendar_years(start: Column, end: Column) -> Column:
    """Difference of the calendar years: counts New Year's Days, not anniversaries."""
    return F.year(end) - F.year(start)


def days_before(moment: Column, days: int) -> Column:
    """A moment `days` earlier, time of day kept."""
    return moment - F.make_dt_interval(F.lit(days))
