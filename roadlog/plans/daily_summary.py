"""Daily vehicle summary: averages, maxima, one vehicle's trace, braking share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlog.operators.rollups import max_of_all, mean_of_numeric, vehicle_trace
from roadlog.plans.common import Output
from roadlog.schemas import CALENDAR, DAILY_METRICS, VEHICLE_DAY
from roadlog.workspace import written


def daily_aggregate(
    df: DataFrame, keys: Sequence[str] = VEHICLE_DAY, metrics: Sequence[str] = DAILY_METRICS
) -> DataFrame:
    """Everything the summary needs per key, in one pass: ``avg_<m>``, ``max_<m>``,
    the rows ``n`` and the rows with an active brake ``active``."""
    return df.groupBy(*keys).agg(
        *[F.avg(m).alias(f"avg_{m}") for m in metrics],
        *[F.max(m).alias(f"max_{m}") for m in metrics],
        F.count("*").alias("n"),
        F.count_if("breakActive").alias("active"),
    )


def daily_summary(
    df: DataFrame,
    vehicle: object,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = DAILY_METRICS,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, Output]:
    """The four results of the daily summary.

    Three of them come from one aggregate over the table instead of one scan
    each; ``stage`` computes it once, however many sinks read it.
    """
    daily = stage(daily_aggregate(df, keys, metrics))
    total = daily.agg(F.sum("n")).scalar()
    braking = daily.filter(F.col("active") > 0).select(
        *keys,
        F.col("active").alias("count"),
        F.try_divide(F.col("active"), total).alias("breakingPercentage"),
    )
    trace = vehicle_trace(df, vehicle)
    return {
        "car-avg": Output(daily.select(*keys, *[F.col(f"avg_{m}").alias(m) for m in metrics]), keys, CALENDAR),
        "car-max": Output(daily.select(*keys, *[F.col(f"max_{m}").alias(m) for m in metrics]), keys, CALENDAR),
        "car-pos": Output(trace, ("id", "timestamp"), CALENDAR),
        "car-breaking": Output(braking, keys, CALENDAR),
    }


def daily_summary_all_columns(
    df: DataFrame,
    vehicle: object,
    keys: Sequence[str] = VEHICLE_DAY,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, Output]:
    """The summary over every column instead of a metric list, as documents only."""
    return {
        "car-avg": Output(stage(mean_of_numeric(df, keys)), keys, table=False),
        "car-max": Output(stage(max_of_all(df, keys)), keys, table=False),
        "car-pos": Output(vehicle_trace(df, vehicle), ("id", "timestamp"), table=False),
    }
