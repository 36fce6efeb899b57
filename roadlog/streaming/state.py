"""Streams whose state is a table: copies however late, days that are corrected, profiles.

What a stream has to remember for ever does not fit its state store.  Here it is a table
of :mod:`roadlog.streaming.commits` that every micro-batch adds its part to: keys seen,
partial aggregates, counts of types.  Parts are merged when they are read, and by
compaction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlog.operators.nested import schema_profile
from roadlog.schemas import DAILY_METRICS
from roadlog.streaming import commits


def _started(stream: DataFrame, run, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# --- copies -------------------------------------------------------------------

_LEDGER = "_key1 long, _key2 long, _day date"


def _key_hashes(keys: Sequence[str]) -> list[Column]:
    # a null is told from a missing value by its place
    marked = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return [F.xxhash64(F.lit(n), *marked).alias(f"_key{n}") for n in (1, 2)]


def start_dedup(
    stream: DataFrame,
    table: str,
    ledger: str,
    checkpoint: str,
    keys: Sequence[str] = ("id", "timestamp"),
    day: Column | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the first row of each key to ``table``; later ones go, however late they are.

    ``ledger`` holds 128 bits of every key seen, by ``day``: a DATE that the key determines
    (default: the UTC day of ``timestamp`` in milliseconds; a literal where there is
    none).  A batch is compared with the days it has rows of, so a batch of today's
    readings reads today's keys; Spark broadcasts the keys of a small batch and otherwise
    filters the ledger with a Bloom filter of them.  Of copies in one batch the least row
    stays.  A batch that runs again meets the keys of the batches before
    it only and replaces what it wrote, so a replay changes nothing.
    """
    of_day = F.to_date(F.timestamp_millis("timestamp")) if day is None else day
    columns = stream.columns

    def run(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        named = rows.select("*", *_key_hashes(keys), of_day.alias("_day"))
        # nulls are a day of their own
        days = [r._day for r in named.select("_day").distinct().collect()]
        here = F.col("_day").isin([d for d in days if d is not None]) | (F.lit(None in days) & F.col("_day").isNull())
        seen = commits.read(spark, ledger, _LEDGER, before=batch, where=here)
        once = named.groupBy("_key1", "_key2").agg(F.min(F.struct(*columns, "_day")).alias("_row"))
        fresh = once.join(seen.select("_key1", "_key2"), ["_key1", "_key2"], "left_anti")
        commits.append(fresh.select("_row.*").drop("_day"), table, batch)
        # from what was written: the rows are compared with the ledger once
        kept = commits.read(spark, table, rows.schema).filter(F.col(commits.BATCH) == batch)
        commits.append(kept.select(*_key_hashes(keys), of_day.alias("_day")), ledger, batch, ("_day",))

    return _started(stream, run, checkpoint, available_now)


def compact_ledger(spark: SparkSession, ledger: str, trim: bool = False) -> None:
    """Join the keys of all batches, still by day."""
    commits.compact(spark, ledger, _LEDGER, ("_day",), trim=trim)


# --- days that are corrected --------------------------------------------------

_PARTS = {"sum": F.sum, "n": F.count, "min": F.min, "max": F.max}
_MERGED = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max}


def _part_schema(keys: Sequence[T.StructField], metrics: Sequence[T.StructField]) -> T.StructType:
    fields = [*keys, T.StructField("_day", T.DateType())]
    for m in metrics:
        kinds = {"sum": T.DoubleType(), "n": T.LongType(), "min": m.dataType, "max": m.dataType}
        fields += [T.StructField(f"{part}_{m.name}", kind) for part, kind in kinds.items()]
    return T.StructType([*fields, T.StructField("rows", T.LongType())])


def partial_daily(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], day: Column) -> DataFrame:
    """What a day's summaries are made of: sum, count, minimum and maximum of each metric."""
    parts = []
    for m in metrics:
        parts += [f(F.col(m).cast("double") if part == "sum" else m).alias(f"{part}_{m}") for part, f in _PARTS.items()]
    return df.groupBy(*keys, day.alias("_day")).agg(*parts, F.count("*").alias("rows"))


def merged_daily(parts: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Partial summaries of the same key and day in one."""
    merged = [f(f"{part}_{m}").alias(f"{part}_{m}") for m in metrics for part, f in _MERGED.items()]
    return parts.groupBy(*keys, "_day").agg(*merged, F.sum("rows").alias("rows"))


def start_daily(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str] = ("id",),
    metrics: Sequence[str] = DAILY_METRICS,
    day: Column | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep daily summaries that late rows correct, whenever they come.

    Every micro-batch adds its partial summaries; nothing is rescanned and there is no
    watermark, since days never close.
    """
    of_day = F.to_date(F.timestamp_millis("timestamp")) if day is None else day

    def run(rows: DataFrame, batch: int) -> None:
        commits.append(partial_daily(rows, keys, metrics, of_day), root, batch)

    return _started(stream, run, checkpoint, available_now)


def daily(
    spark: SparkSession,
    root: str,
    keys: Sequence[T.StructField],
    metrics: Sequence[T.StructField],
) -> DataFrame:
    """``(*keys, year, month, day, avg_m, min_m, max_m for every metric, rows)`` of all days,
    the open one included."""
    names, values = [k.name for k in keys], [m.name for m in metrics]
    whole = merged_daily(commits.read(spark, root, _part_schema(keys, metrics)), names, values)
    shown = []
    for m in values:
        # no value, no mean
        mean = F.try_divide(f"sum_{m}", f"n_{m}")
        shown += [mean.alias(f"avg_{m}"), F.col(f"min_{m}"), F.col(f"max_{m}")]
    return whole.select(
        *names, F.year("_day").alias("year"), F.month("_day").alias("month"), F.dayofmonth("_day").alias("day"), *shown, "rows"
    )


def compact_daily(
    spark: SparkSession,
    root: str,
    keys: Sequence[T.StructField],
    metrics: Sequence[T.StructField],
    trim: bool = False,
) -> None:
    """One partial summary for each key and day, in place of one a batch."""
    names, values = [k.name for k in keys], [m.name for m in metrics]
    commits.compact(
        spark, root, _part_schema(keys, metrics), combine=lambda parts: merged_daily(parts, names, values), trim=trim
    )


# --- schema profiles ----------------------------------------------------------

_PROFILE = "file string, path string, type string, n long"


def start_profile(
    spark: SparkSession, path: str, root: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Profile the JSON documents (a line each) of files below ``path`` that are new.

    The counts of each file are kept, so files that were profiled are not read again.
    """
    lines = (
        spark.readStream.option("recursiveFileLookup", "true")
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )

    def run(rows: DataFrame, batch: int) -> None:
        commits.append(schema_profile(rows, "value", ("file",)), root, batch)

    return _started(lines, run, checkpoint, available_now)


def profile(spark: SparkSession, root: str, gone: DataFrame | None = None) -> DataFrame:
    """``path, type, n`` over all files profiled, less those named in ``gone (file)``."""
    counts = commits.read(spark, root, _PROFILE)
    if gone is not None:
        counts = counts.join(gone.select("file"), "file", "left_anti")
    return counts.groupBy("path", "type").agg(F.sum("n").alias("n"))
