"""Calendar columns from epoch milliseconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local_time(millis: Column, tz: str = "UTC") -> Column:
    """Wall-clock time (TIMESTAMP_NTZ) of an epoch-millisecond column in ``tz``.

    The result does not depend on the session zone.
    """
    session_clock = F.timestamp_millis(millis).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(tz), session_clock)


def with_calendar(df: DataFrame, ts: str = "timestamp", tz: str = "UTC") -> DataFrame:
    """Add ``year``, ``month`` and ``day`` (INT) of the epoch-millisecond column ``ts``."""
    clock = local_time(F.col(ts), tz)
    return df.withColumns(
        {"year": F.year(clock), "month": F.month(clock), "day": F.dayofmonth(clock)}
    )


def with_date(df: DataFrame, date: dt.date | None) -> DataFrame:
    """Stamp every row with the same calendar date; ``None`` leaves the rows alone."""
    if date is None:
        return df
    return df.withColumns(
        {"year": F.lit(date.year), "month": F.lit(date.month), "day": F.lit(date.day)}
    )


def date_range(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows from ``first`` to ``last`` (both included) of a table with calendar columns.

    Besides the exact comparison, the bare ``year`` bounds are stated so that a
    table partitioned by ``year, month, day`` is pruned before it is listed.
    """
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return df.filter(
        F.col("year").between(first.year, last.year)
        & key.between(
            first.year * 10000 + first.month * 100 + first.day,
            last.year * 10000 + last.month * 100 + last.day,
        )
    )
