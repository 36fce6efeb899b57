"""Consumption and emission per model across fleets with different units."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.functions.columns import convert_units, nan_to_null
from roadlog.operators.relational import full_outer_on, union_named
from roadlog.operators.rollups import drop_null_keys, rollup
from roadlog.operators.wear import split_null_keys
from roadlog.schemas import KM_PER_MILE
from roadlog.workspace import written

EMISSION_METRICS = ("consumptionKm", "co2Km")
PER_MILE = {"consumptionMile": "consumptionKm", "co2Mile": "co2Km"}


def common_units(
    eu: DataFrame,
    usa: DataFrame,
    factor: float = KM_PER_MILE,
    mapping: Mapping[str, str] = PER_MILE,
    key: str = "model",
) -> DataFrame:
    """Rows of both fleets with per-kilometre columns only."""
    metrics = list(mapping.values())
    converted = convert_units(usa.select(key, *mapping), mapping, factor)
    return union_named(eu.select(key, *metrics), converted)


def emission_by_model(
    eu: DataFrame,
    usa: DataFrame,
    factor: float = KM_PER_MILE,
    null_key_mode: str = "keep",
    nan_as_null: bool = False,
) -> DataFrame:
    """Mean consumption and CO2 per kilometre and model, over the rows of both fleets."""
    rows = common_units(eu, usa, factor)
    if null_key_mode == "drop":
        rows = drop_null_keys(rows, ["model"])
    means = rollup(rows, ["model"], EMISSION_METRICS, "avg", nan_as_null)
    if null_key_mode == "split":
        means = split_null_keys(means, ["model"], [[m] for m in EMISSION_METRICS])
    return means


def emission_by_model_joined(eu: DataFrame, usa: DataFrame, factor: float = KM_PER_MILE) -> DataFrame:
    """The same as a join of one aggregate per metric, kept for comparison."""
    rows = common_units(eu, usa, factor)
    return full_outer_on(["model"], *[rollup(rows, ["model"], [m], "avg") for m in EMISSION_METRICS])


def model_statistics(
    df: DataFrame,
    averages: Sequence[str] = ("consumptionMile",),
    maxima: Sequence[str] = ("mph",),
    null_key_mode: str = "keep",
    nan_as_null: bool = False,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, DataFrame]:
    """``{'avg': ..., 'max': ...}`` per model, two frames of one aggregate.

    ``stage`` computes it once.
    """
    if null_key_mode == "drop":
        df = drop_null_keys(df, ["model"])

    def value(metric: str) -> Column:
        return nan_to_null(metric, df.schema[metric].dataType) if nan_as_null else F.col(metric)

    both = stage(
        df.groupBy("model").agg(
            *[F.avg(value(m)).alias(f"avg_{m}") for m in averages], *[F.max(value(m)).alias(f"max_{m}") for m in maxima]
        )
    )
    return {
        "avg": both.select("model", *[F.col(f"avg_{m}").alias(m) for m in averages]),
        "max": both.select("model", *[F.col(f"max_{m}").alias(m) for m in maxima]),
    }
