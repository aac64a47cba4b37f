"""Monday-based week and month arithmetic relative to a fixed ``as_of`` day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def monday(value: dt.date) -> dt.date:
    return value - dt.timedelta(days=value.weekday())


def week_start(date: Column) -> Column:
    return F.trunc(date, "week")


def week_rel(date: Column, as_of: dt.date) -> Column:
    """Whole weeks back from the week of ``as_of``; 0 is that week, 1 the one before."""
    return F.floor(F.datediff(day(monday(as_of)), week_start(date)) / 7).cast("int")


def in_weeks(date: Column, as_of: dt.date, newest: int, oldest: int) -> Column:
    """Week offsets ``newest..oldest`` as a plain date range, which scans can prune on."""
    first = monday(as_of) - dt.timedelta(weeks=oldest)
    last = monday(as_of) - dt.timedelta(weeks=newest) + dt.timedelta(days=6)
    return date.between(day(first), day(last))


def in_month(date: Column, as_of: dt.date, up_to_as_of: bool = False) -> Column:
    """Same calendar month as ``as_of``, optionally ending at ``as_of``."""
    first = as_of.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    keep = (date >= day(first)) & (date < day(following))
    return keep & (date <= day(as_of)) if up_to_as_of else keep


def week_label(rel: Column) -> Column:
    return (
        F.when(rel == 0, "This Week")
        .when(rel == 1, "Last Week")
        .otherwise(F.concat(rel.cast("string"), F.lit(" Weeks Ago")))
    )


def week_number_label(rel: Column) -> Column:
    return F.concat(F.lit("Week "), (rel + 1).cast("string"))


def date_ordinal(date: Column) -> Column:
    """Days since year one, counting 0001-01-01 as day 1."""
    return F.datediff(date, day(dt.date(1970, 1, 1))) + dt.date(1970, 1, 1).toordinal()
