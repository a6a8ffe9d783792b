"""Dates, periods and time stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(c: Column, strict: bool = True) -> Column:
    """``yyyy-M-d`` text, day and month padded or not, to a date.

    ``strict`` fails on a malformed text; otherwise it becomes null.
    """
    return F.to_date(c, "yyyy-M-d") if strict else F.try_to_date(c, "yyyy-M-d")


def pad_day(c: Column) -> Column:
    """The same text with the day and month padded, so that text order is date order."""
    return F.date_format(parse_day(c), "yyyy-MM-dd")


def date_parts(c: Column) -> list[Column]:
    return [
        F.year(c).alias("Year"),
        F.month(c).alias("Month"),
        F.dayofmonth(c).alias("Day"),
    ]


def recent_months(as_of: Column | dt.date, months: int) -> Column:
    """Array of month starts, from ``months - 1`` months back up to the month of ``as_of``."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    last = F.trunc(day, "month")
    return F.sequence(F.add_months(last, 1 - months), last, F.expr("interval 1 month"))


def period(c: Column) -> Column:
    """``yyyyMM`` of a date."""
    return F.date_format(c, "yyyyMM")


def epoch_ms_text(ms: Column) -> Column:
    """Epoch milliseconds as ``dd-MM-yyyy HH:mm:ss`` in UTC, whatever the session time zone."""
    wall = F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(wall, "dd-MM-yyyy HH:mm:ss")
