"""Date helpers. Every clock use takes an explicit ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | Column | None


def day(value: AsOf) -> Column:
    """Date column from a date, ISO text, a column, ``'today'`` or None (today)."""
    if value is None or (isinstance(value, str) and value == "today"):
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def latest_of(*times: Column) -> Column:
    """Latest non-null value, null when all are null."""
    return F.greatest(*times)


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights from ``start`` to ``end``; negative when end is earlier."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def is_open_on(day_: Column, start: Column, end: Column, as_of: AsOf = None) -> Column:
    """``day_`` lies between ``start`` and the day before ``end`` (or before as_of if open)."""
    last = F.date_sub(F.coalesce(F.to_date(end), day(as_of)), 1)
    return day_.between(F.to_date(start), last)
