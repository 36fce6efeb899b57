"""Wear of parts per vehicle day and per day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlog.operators.rollups import drop_null_keys
from roadlog.operators.wear import extremes, period_mean
from roadlog.plans.common import Output
from roadlog.schemas import CALENDAR, HEALTH_METRICS, VEHICLE_DAY
from roadlog.workspace import written


def wear_report(
    df: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = HEALTH_METRICS,
    period: Sequence[str] = CALENDAR,
    raw_names: bool = False,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, Output]:
    """``wearing-parts-car`` and ``wearing-parts-decrease``.

    The table of the first holds the highest, its documents the lowest health
    values.  ``raw_names`` keeps aggregate names such as ``max(engineHealth)``
    in the table and ``avg(engineHealthDecrease)`` in the second result.
    """
    per_car = stage(extremes(df, keys, metrics))
    wear = per_car.select(
        *keys,
        *[((F.col(f"max_{m}") - F.col(f"min_{m}")) / F.col("count")).alias(f"{m}Decrease") for m in metrics],
    )
    decrease = period_mean(wear, period, [f"{m}Decrease" for m in metrics])
    table = per_car.select(
        *keys, *[F.col(f"max_{m}").alias(f"max({m})" if raw_names else m) for m in metrics]
    )
    documents = per_car.select(*keys, *[F.col(f"min_{m}").alias(m) for m in metrics])
    if raw_names:
        decrease = decrease.withColumnsRenamed({f"{m}Decrease": f"avg({m}Decrease)" for m in metrics})
    return {
        "wearing-parts-car": Output(table, keys, period, documents),
        "wearing-parts-decrease": Output(decrease, period, period),
    }


def wear_report_over_groups(
    df: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = HEALTH_METRICS,
    period: Sequence[str] = CALENDAR,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, Output]:
    """The variant that divides by the number of vehicle days, as documents only.

    Keys with a missing part are left out and NaN is skipped.
    """
    per_car = stage(extremes(drop_null_keys(df, keys), keys, metrics, nan_as_null=True))
    groups = per_car.agg(F.count("*")).scalar()
    wear = per_car.withColumn("_groups", groups).select(
        *keys,
        *[F.try_divide(F.col(f"max_{m}") - F.col(f"min_{m}"), F.col("_groups")).alias(m) for m in metrics],
    )
    lows = per_car.select(*keys, *[F.col(f"min_{m}").alias(m) for m in metrics])
    return {
        "wearing-parts-car": Output(lows, keys, table=False),
        "wearing-parts-decrease": Output(period_mean(wear, period, metrics), period, table=False),
    }
