"""Wear of parts: how fast health values fall."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.operators.relational import aligned_subtract, full_outer_on
from roadlog.operators.rollups import drop_null_keys, group_count, metric_column, rollup
from roadlog.schemas import CALENDAR, HEALTH_METRICS, VEHICLE_DAY
from roadlog.workspace import written

NULL_KEY_MODES = ("keep", "split", "drop")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def split_null_keys(grouped: DataFrame, keys: Sequence[str], parts: Sequence[Sequence[str]]) -> DataFrame:
    """Show a single aggregate the way a join of several aggregates would.

    In a full outer join a group with a missing key matches nothing: it appears
    once per joined aggregate, each time with only that aggregate's columns.
    ``parts`` lists the columns of each aggregate.
    """
    copies = F.when(_any_null(keys), F.sequence(F.lit(0), F.lit(len(parts) - 1))).otherwise(
        F.array(F.lit(None).cast("int"))
    )
    exploded = grouped.withColumn("_part", F.explode(copies))
    owner = {c: i for i, part in enumerate(parts) for c in part}
    return exploded.select(
        *keys,
        *[
            F.when(F.col("_part").isNull() | (F.col("_part") == owner[c]), F.col(c)).alias(c)
            for c in grouped.columns
            if c not in keys
        ],
    )


def wear_rate(
    df: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = HEALTH_METRICS,
    denominator: str = "rows",
    null_key_mode: str = "keep",
    nan_as_null: bool = False,
    suffix: str = "Decrease",
) -> DataFrame:
    """``(max - min) / n`` of each metric per key, as ``<metric><suffix>``.

    ``n`` is the number of rows of the key (``'rows'``) or the number of keys in
    the table (``'groups'``).  ``null_key_mode`` says what happens to keys with a
    missing part: one group (``keep``), what a join of separate aggregates
    would give (``split``), or left out (``drop``).
    """
    if denominator not in ("rows", "groups"):
        raise ValueError(f"unknown denominator: {denominator}")
    if null_key_mode not in NULL_KEY_MODES:
        raise ValueError(f"unknown null_key_mode: {null_key_mode}")
    if denominator == "groups" and null_key_mode == "split":
        raise ValueError("null_key_mode='split' needs denominator='rows'")
    if null_key_mode == "drop":
        df = drop_null_keys(df, keys)
    if denominator == "groups":
        return _wear_over_groups(df, keys, metrics, nan_as_null, suffix)
    grouped = extremes(df, keys, metrics, nan_as_null)
    if null_key_mode == "split":
        grouped = split_null_keys(
            grouped, keys, [[f"max_{m}" for m in metrics], [f"min_{m}" for m in metrics], ["count"]]
        )
    return _wear_columns(grouped, keys, metrics, suffix)


def extremes(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], nan_as_null: bool = False
) -> DataFrame:
    """``max_<m>``, ``min_<m>`` of each metric and ``count``, in one aggregate."""
    return df.groupBy(*keys).agg(
        *[F.max(metric_column(df, m, nan_as_null)).alias(f"max_{m}") for m in metrics],
        *[F.min(metric_column(df, m, nan_as_null)).alias(f"min_{m}") for m in metrics],
        F.count("*").alias("count"),
    )


def _wear_columns(grouped: DataFrame, keys, metrics, suffix) -> DataFrame:
    return grouped.select(
        *keys,
        *[((F.col(f"max_{m}") - F.col(f"min_{m}")) / F.col("count")).alias(m + suffix) for m in metrics],
    )


def _wear_over_groups(df, keys, metrics, nan_as_null, suffix) -> DataFrame:
    # computed once: the groups are counted in the aggregate that gives the wear
    grouped = written(extremes(df, keys, metrics, nan_as_null), "extremes")
    groups = grouped.agg(F.count("*")).scalar()
    return grouped.withColumn("_groups", groups).select(
        *keys,
        *[
            F.try_divide(
                F.when(
                    F.col(f"max_{m}").isNotNull(),
                    F.col(f"max_{m}") - F.col(f"min_{m}"),
                ),
                F.col("_groups"),
            ).alias(m + suffix)
            for m in metrics
        ],
    )


def wear_rate_joined(
    df: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = HEALTH_METRICS,
    suffix: str = "Decrease",
) -> DataFrame:
    """The same wear as a three-way join of separate aggregates.

    Kept for comparison with :func:`wear_rate`, which reads the table once.
    """
    highs = rollup(df, keys, metrics, "max").withColumnsRenamed({m: f"max_{m}" for m in metrics})
    lows = rollup(df, keys, metrics, "min").withColumnsRenamed({m: f"min_{m}" for m in metrics})
    return _wear_columns(full_outer_on(keys, highs, lows, group_count(df, keys)), keys, metrics, suffix)


def wear_from_extremes(
    highs: DataFrame,
    lows: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = HEALTH_METRICS,
    suffix: str = "Decrease",
) -> DataFrame:
    """Wear over the number of keys, from two ready tables of extremes.

    The tables may cover different keys; a value missing in one counts as 0.
    """
    groups = highs.agg(F.count("*")).scalar()
    return (
        aligned_subtract(highs, lows, keys, metrics)
        .withColumn("_groups", groups)
        .select(*keys, *[F.try_divide(F.col(m), F.col("_groups")).alias(m + suffix) for m in metrics])
    )


def period_mean(
    df: DataFrame,
    period_keys: Sequence[str] = CALENDAR,
    metrics: Sequence[str] = tuple(m + "Decrease" for m in HEALTH_METRICS),
) -> DataFrame:
    """Mean over the vehicles of a period; each vehicle weighs the same."""
    return rollup(df, period_keys, metrics, "avg")
