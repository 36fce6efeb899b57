"""Grouped summaries of telemetry rows.

Each function plans one grouped aggregate: a partial aggregate runs before the
only shuffle, so a key that owns most of the rows reaches the shuffle as one
row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.functions.columns import nan_to_null
from roadlog.schemas import DAILY_METRICS, TRACE_COLUMNS, VEHICLE_DAY

_FUNCTIONS = {"avg": F.avg, "max": F.max, "min": F.min}
_NOT_ORDERED = (T.MapType, T.VariantType)


def metric_column(df: DataFrame, name: str, nan_as_null: bool) -> Column:
    return nan_to_null(name, df.schema[name].dataType) if nan_as_null else F.col(name)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present."""
    return df.dropna(subset=list(keys))


def rollup(
    df: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    metrics: Sequence[str] = DAILY_METRICS,
    fn: str = "avg",
    nan_as_null: bool = False,
) -> DataFrame:
    """``avg``, ``max`` or ``min`` of the metrics per key; columns keep their names.

    ``nan_as_null`` skips NaN; otherwise one NaN makes an average NaN and is
    the largest value.
    """
    agg = _FUNCTIONS[fn]
    return df.groupBy(*keys).agg(*[agg(metric_column(df, m, nan_as_null)).alias(m) for m in metrics])


def group_count(df: DataFrame, keys: Sequence[str] = VEHICLE_DAY, name: str = "count") -> DataFrame:
    """Rows per key, whether or not their metrics are present."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def total_count(df: DataFrame, name: str = "count") -> DataFrame:
    """One row: the number of rows (lazy)."""
    return df.agg(F.count("*").alias(name))


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    """Names of the numeric and boolean columns."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in without and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def mean_of_numeric(
    df: DataFrame, keys: Sequence[str] = VEHICLE_DAY, nan_as_null: bool = True
) -> DataFrame:
    """Mean of every numeric column that is not a key; booleans count as 0 and 1.

    Rows with a missing key are left out.
    """
    aggs = []
    for name in numeric_columns(df, keys):
        c = metric_column(df, name, nan_as_null)
        if isinstance(df.schema[name].dataType, T.BooleanType):
            c = c.cast("int")
        aggs.append(F.avg(c).alias(name))
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def max_of_all(
    df: DataFrame, keys: Sequence[str] = VEHICLE_DAY, nan_as_null: bool = True
) -> DataFrame:
    """Largest value of every column that is not a key and has an order.

    Rows with a missing key are left out.
    """
    names = [
        f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, _NOT_ORDERED)
    ]
    return (
        drop_null_keys(df, keys)
        .groupBy(*keys)
        .agg(*[F.max(metric_column(df, n, nan_as_null)).alias(n) for n in names])
    )


def share_of_total(
    df: DataFrame,
    keys: Sequence[str] = VEHICLE_DAY,
    predicate: Column | str = "breakActive",
    denominator: str = "all",
    share_name: str = "breakingPercentage",
) -> DataFrame:
    """``(*keys, count, share)``: matching rows per key and their share.

    ``denominator='all'`` divides by the rows of the whole table and has no
    row for keys without a match.  ``'group'`` divides by the rows of the key
    and keeps every key.  The share is a fraction.
    """
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    if denominator == "all":
        # the total is a scalar subquery: it scans no columns and is lazy
        total = df.agg(F.count("*")).scalar()
        return group_count(df.filter(p), keys).withColumn(share_name, F.try_divide(F.col("count"), total))
    if denominator == "group":
        return df.groupBy(*keys).agg(
            F.count_if(p).alias("count"), F.try_divide(F.count_if(p), F.count("*")).alias(share_name)
        )
    raise ValueError(f"unknown denominator: {denominator}")


def vehicle_trace(
    df: DataFrame, vehicle: object, columns: Sequence[str] = TRACE_COLUMNS, key: str = "id"
) -> DataFrame:
    """The chosen columns of one vehicle's rows (the comparison reaches the scan)."""
    return df.filter(F.col(key) == F.lit(vehicle)).select(*columns)


def first_rows(df: DataFrame, n: int = 200, order: Sequence[str] = ("timestamp", "id")) -> DataFrame:
    """The first ``n`` rows in a stated order (a distributed top-k)."""
    return df.orderBy(*order).limit(n)
