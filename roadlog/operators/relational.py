"""Joins and unions used by the analyses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_outer_on(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Full outer equi-join of several frames with coalesced keys.

    A missing key equals nothing, so such rows stay unmatched.
    """
    return reduce(lambda left, right: left.join(right, on=list(keys), how="full_outer"), frames)


def aligned_subtract(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    fill: float = 0,
) -> DataFrame:
    """``left - right`` per key; a value missing on one side counts as ``fill``.

    A value missing on both sides stays missing.  Missing keys match each other.
    """
    l, r = left.alias("l"), right.alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    difference = [
        F.when(
            F.col(f"l.{m}").isNotNull() | F.col(f"r.{m}").isNotNull(),
            F.coalesce(f"l.{m}", F.lit(fill)) - F.coalesce(f"r.{m}", F.lit(fill)),
        ).alias(m)
        for m in metrics
    ]
    return l.join(r, same, "full_outer").select(
        *[F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys], *difference
    )


def union_positional(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, columns matched by position, duplicates kept."""
    return reduce(DataFrame.union, others, first)


def union_named(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, columns matched by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)
