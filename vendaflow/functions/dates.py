"""Date parameters and partition-aware date predicates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def days_before(value: str | date, days: int) -> date:
    return as_date(value) - timedelta(days=days)


def date_window(column: str, start: str | date | None = None, end: str | date | None = None,
                year: str | None = None, month: str | None = None) -> Column:
    """`start <= column < end`, with the implied (year, month) bounds when those columns are given.

    The fact is partitioned by year and month but queried by day; the extra bounds let the scan
    skip whole partitions.
    """
    cond = F.lit(True)
    if start is not None:
        start = as_date(start)
        cond = cond & (F.col(column) >= F.lit(start))
        if year and month:
            cond = cond & ((F.col(year) > start.year) |
                           ((F.col(year) == start.year) & (F.col(month) >= start.month)))
    if end is not None:
        end = as_date(end)
        cond = cond & (F.col(column) < F.lit(end))
        if year and month:
            cond = cond & ((F.col(year) < end.year) |
                           ((F.col(year) == end.year) & (F.col(month) <= end.month)))
    return cond
