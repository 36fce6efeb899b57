"""Emission comparison between fleets, and per-model statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from roadlog.operators.emissions import emission_by_model, model_statistics
from roadlog.plans.common import Output
from roadlog.schemas import KM_PER_MILE
from roadlog.workspace import written


def emission_report(
    eu: DataFrame,
    usa: DataFrame,
    factor: float = KM_PER_MILE,
    null_key_mode: str = "keep",
    nan_as_null: bool = False,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, Output]:
    """Mean consumption and emission per kilometre and model over both fleets.

    ``null_key_mode='drop'`` with ``nan_as_null`` gives what a data frame
    library gives that leaves missing keys and NaN out.
    """
    means = stage(emission_by_model(eu, usa, factor, null_key_mode, nan_as_null))
    return {"consumption-emission": Output(means, ("model",))}


def model_report(
    usa: DataFrame,
    null_key_mode: str = "keep",
    nan_as_null: bool = False,
    stage: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, Output]:
    """Mean consumption and top speed per model, as documents only."""
    stats = model_statistics(usa, null_key_mode=null_key_mode, nan_as_null=nan_as_null, stage=stage)
    return {
        "mile-avg-usa": Output(stats["avg"], ("model",), table=False),
        "mph-max-usa": Output(stats["max"], ("model",), table=False),
    }
