"""Tables that micro-batches append to, with a list of what counts.

Every append writes a folder of its own and then one row in the list: which batches the
folder holds.  Of the folders for a batch only the newest counts, so a batch that runs
again replaces what it wrote before, and a folder without a row counts for nothing.
:func:`compact` joins the folders of many batches in one, so neither their number nor that
of files grows with the number of batches for ever.  There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.workspace import remove_folder

_LIST = "number long, first long, last long, folder string"
BATCH = "batch"


def _listed(spark: SparkSession, root: str) -> list:
    """Rows of the list, the oldest first: one a batch since the last compaction, and
    one a compaction."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/list")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return []
    return sorted(spark.read.schema(_LIST).parquet(f"{root}/list").collect(), key=lambda r: r.number)


def _live(rows: list) -> list:
    """What no later row covers."""
    kept: list = []
    for row in rows:
        kept = [r for r in kept if not (row.first <= r.first and r.last <= row.last)]
        kept.append(row)
    return kept


def _enlist(spark: SparkSession, root: str, number: int, first: int, last: int, folder: str) -> None:
    row = spark.createDataFrame([(number, first, last, folder)], _LIST)
    row.coalesce(1).write.mode("append").parquet(f"{root}/list")


def _write(df: DataFrame, root: str, label: str, by: Sequence[str]) -> str:
    folder = f"{label}-{uuid.uuid4().hex[:8]}"
    writer = (df.hint("rebalance", *by) if by else df).write
    (writer.partitionBy(*by) if by else writer).parquet(f"{root}/data/{folder}")
    return folder


def append(df: DataFrame, root: str, batch: int, by: Sequence[str] = ()) -> None:
    """Write the rows of a micro-batch; ``by`` are partition columns."""
    spark = df.sparkSession
    folder = _write(df.withColumn(BATCH, F.lit(batch).cast("long")), root, str(batch), by)
    rows = _listed(spark, root)
    _enlist(spark, root, rows[-1].number + 1 if rows else 0, batch, batch, folder)


def read(
    spark: SparkSession, root: str, schema: T.StructType | str, before: int | None = None, where: Column | None = None
) -> DataFrame:
    """The rows that count, with their ``batch``; ``before`` leaves out that batch and later
    ones.  ``where`` on partition columns prunes their folders."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    found = []
    for row in _live(_listed(spark, root)):
        if before is None or row.first < before:
            path = f"{root}/data/{row.folder}"
            found.append(spark.read.schema(whole).option("basePath", path).parquet(path).select(*whole.names))
    if not found:
        return spark.createDataFrame([], whole)
    together = found[0]
    for rows in found[1:]:
        together = together.unionAll(rows)
    if before is not None:
        together = together.filter(F.col(BATCH) < before)
    return together if where is None else together.filter(where)


def compact(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str,
    by: Sequence[str] = (),
    combine: Callable[[DataFrame], DataFrame] | None = None,
    trim: bool = False,
) -> None:
    """Write all that counts as one folder.

    ``combine`` may shrink the rows (``batch`` included; a combined row counts as one of the
    last batch).  ``trim`` removes the folders that count no more; readers that have
    opened them lose them.
    """
    rows = _listed(spark, root)
    live = _live(rows)
    if len(live) < 2:
        return
    first, last = min(r.first for r in live), max(r.last for r in live)
    held = read(spark, root, schema)
    if combine is not None:
        held = combine(held.drop(BATCH)).withColumn(BATCH, F.lit(last).cast("long"))
    folder = _write(held, root, f"{first}-to-{last}", by)
    _enlist(spark, root, rows[-1].number + 1, first, last, folder)
    if trim:
        for row in rows:
            remove_folder(spark, f"{root}/data/{row.folder}")
