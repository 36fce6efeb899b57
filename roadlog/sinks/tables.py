"""Table and text writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlog.operators.documents import bulk_pairs
from roadlog.operators.nested import rows_to_json
from roadlog.schemas import CALENDAR
from roadlog.sources.files import read_csv


def append_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = CALENDAR,
    replace_touched: bool = False,
    cluster: bool = True,
) -> None:
    """Write to a Parquet table partitioned by ``by``.

    Appending twice duplicates the rows; ``replace_touched`` instead replaces
    exactly the partitions that occur in ``df``, so a rerun changes nothing.
    ``cluster`` gathers each partition's rows before writing, with the number of
    writers per partition left to the adaptive planner (large ones are split),
    so a table of many days does not become tasks times days small files.
    """
    out = df.hint("rebalance", *by) if cluster else df
    writer = out.write.partitionBy(*by)
    if replace_touched:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append to an unpartitioned Parquet table."""
    df.write.mode("append").parquet(path)


def write_bulk_file(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite", **options) -> None:
    """NDJSON bulk file: an action line and a source line per row."""
    bulk_pairs(df, keys, **options).write.mode(mode).text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append", keep_nulls: bool = False) -> None:
    """One JSON object per line."""
    rows_to_json(df, keep_nulls=keep_nulls).write.mode(mode).text(path)


def write_text(df: DataFrame, path: str, column: str | None = None, mode: str = "append") -> None:
    """One text column as lines."""
    df.select(F.col(column or df.columns[0]).cast("string")).write.mode(mode).text(path)


def csv_to_parquet(spark: SparkSession, csv_path, parquet_path: str, schema=None, mode: str = "overwrite") -> bool:
    """Convert CSV with a header to Parquet; false when there were no rows."""
    df = read_csv(spark, csv_path, schema)
    df.write.mode(mode).parquet(parquet_path)
    return not spark.read.schema(df.schema).parquet(parquet_path).isEmpty()
