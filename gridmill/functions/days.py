"""UTC days, months, composite windows and period predicates.

Timestamps without zone are UTC by contract; for zoned ones the session zone must be UTC
(``gridmill.session.configure``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmill.schemas import DAYS_AFTER_CENTRE, DAYS_BEFORE_CENTRE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(d: dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


def utc_day(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def composite_start(centre: Column | str) -> Column:
    return F.date_sub(F.to_date(_col(centre)), DAYS_BEFORE_CENTRE)


def composite_end(centre: Column | str) -> Column:
    return F.date_add(F.to_date(_col(centre)), DAYS_AFTER_CENTRE)


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month; NULL for a month outside 1..12 (``make_date`` alone would raise)."""
    year, month = _col(year), _col(month)
    return F.when(month.between(1, 12), F.make_date(year.cast("int"), month.cast("int"), F.lit(1)))


def month_end(year: Column | str, month: Column | str) -> Column:
    return F.last_day(month_start(year, month))


def month_key(date: Column | str) -> Column:
    """Partition key of a month, such as ``2024-01``."""
    return F.date_format(_col(date), "yyyy-MM")


def day_array(start: Column | str, end: Column | str) -> Column:
    """All days from start to end, inclusive; empty if end is before start.

    The guard matters: ``sequence`` would otherwise count downwards.
    """
    start, end = _col(start), _col(end)
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def day_of_year(date: Column | str) -> Column:
    return F.dayofyear(_col(date)).cast("bigint")


def month_of_year(date: Column | str) -> Column:
    return F.month(_col(date)).cast("bigint")


def in_days(date: Column | str, d0: dt.date | Column, d1: dt.date | Column) -> Column:
    return _col(date).between(_date(d0), _date(d1))


def overlaps(start: Column | str, end: Column | str, d0: dt.date | Column, d1: dt.date | Column) -> Column:
    """The period [start, end] has at least one day in [d0, d1]."""
    return (_col(start) <= _date(d1)) & (_col(end) >= _date(d0))


def in_utc_window(
    ts: Column | str, d0: dt.date, d1: dt.date, pad_days: int = 0, end_exclusive: bool = True
) -> Column:
    """Timestamp in the days [d0, d1], the end moved out by ``pad_days``.

    The bounds are literals, so the predicate is pushed to the scan. With
    ``end_exclusive=False`` the window ends at 00:00 of the last day, that instant included.
    """
    ts = _col(ts)
    last = d1 + dt.timedelta(days=pad_days)
    if end_exclusive:
        return (ts >= F.lit(d0)) & (ts < F.lit(last + dt.timedelta(days=1)))
    return (ts >= F.lit(d0)) & (ts <= F.lit(last))


def rfc3339_utc(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
