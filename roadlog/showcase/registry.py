"""Named queries ``(spark, folder) -> DataFrame`` and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlog.session import apply_runtime_conf



def undotted(df: DataFrame) -> DataFrame:
    """Column names with ``_`` for the dots of flattened paths."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL to compare it with."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        @functools.wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(apply_runtime_conf(spark), folder)

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql.strip()
        return run

    return register
