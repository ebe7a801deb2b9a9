"""Calendar keys taken from a ticket's time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_time(time: Column) -> Column:
    """The time as TIMESTAMP; text that is no time gives NULL, under ANSI mode too."""
    return time.try_cast("timestamp")


def month_key(time: Column) -> Column:
    """``yyyyMM``, cut from the text of the time, so no time zone enters it."""
    return F.regexp_replace(F.substring(time.cast("string"), 1, 7), "-", "")


def month_of(time: Column) -> Column:
    """Start of the month, in the session time zone."""
    return F.date_trunc("month", as_time(time))


def year_of(time: Column) -> Column:
    """Start of the year, in the session time zone."""
    return F.date_trunc("year", as_time(time))
