"""Daily summaries of a stream, duplicates and late data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlog.schemas import CALENDAR, DAILY_METRICS
from roadlog.sinks.tables import append_partitioned

EVENT_TIME = "event_time"

_FUNCTIONS = {"avg": F.avg, "max": F.max, "min": F.min}


def with_event_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``event_time`` (TIMESTAMP) from epoch milliseconds."""
    return df.withColumn(EVENT_TIME, F.timestamp_millis(ts))


def stream_daily(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    metrics: Sequence[str] = DAILY_METRICS,
    fn: str = "avg",
    watermark: str = "1 hour",
    event_time: str = EVENT_TIME,
) -> DataFrame:
    """``(*keys, year, month, day, *metrics, count)`` per key and UTC day.

    In append mode a day comes out once the watermark has passed its end; rows
    later than that are dropped.  The state holds one small row per key and
    open day.
    """
    agg = _FUNCTIONS[fn]
    day = F.window(event_time, "1 day")
    daily = (
        df.withWatermark(event_time, watermark)
        .groupBy(*keys, day)
        .agg(*[agg(m).alias(m) for m in metrics], F.count("*").alias("count"))
    )
    date = F.to_date(F.col("window.start"))
    return daily.select(
        *keys,
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        *metrics,
        "count",
    )


def stream_dedup(
    df: DataFrame,
    keys: Sequence[str] = ("id", "timestamp"),
    watermark: str = "1 hour",
    event_time: str = EVENT_TIME,
) -> DataFrame:
    """Drop redelivered rows: of each key only the first within the watermark stays."""
    return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))


def dedup(df: DataFrame, keys: Sequence[str] = ("id", "timestamp")) -> DataFrame:
    """Batch form of :func:`stream_dedup`."""
    return df.dropDuplicates(list(keys))


def touched_days(history: DataFrame, arrivals: DataFrame, by: Sequence[str] = CALENDAR) -> DataFrame:
    """Rows of ``history`` on the days that occur in ``arrivals``.

    A semi join on the partition columns, so Spark can prune the other days.
    """
    return history.join(arrivals.select(*by).distinct(), list(by), "left_semi")


def rebuild_days(
    history: DataFrame,
    arrivals: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    by: Sequence[str] = CALENDAR,
) -> None:
    """Late data: build the touched days again from ``history`` (which already
    contains the arrivals) and replace just those days of the table at ``path``."""
    append_partitioned(build(touched_days(history, arrivals, by)), path, by, replace_touched=True)
