"""Incremental ingest of message files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlog import schemas
from roadlog.sinks.tables import append_partitioned
from roadlog.sources.messages import Messages, decode_messages, frame_messages, split_messages, staged


def stream_messages(
    spark: SparkSession,
    path: str,
    value_schema: T.StructType = schemas.EU_VALUE,
    framing: str = "lines",
    tz: str = "UTC",
    max_files: int | None = None,
) -> Messages:
    """Streaming rows and rejects of message files below a path, as they land.

    Each of the two frames reads the files on its own when it is started;
    :func:`start_ingest` writes both from one pass.
    """
    return split_messages(_decoded(spark, path, value_schema, framing, max_files), tz)


def _decoded(spark, path, value_schema, framing, max_files) -> DataFrame:
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return decode_messages(frame_messages(lines, framing), value_schema)


def start_ingest(
    spark: SparkSession,
    path: str,
    table: str,
    rejects: str,
    checkpoint: str,
    value_schema: T.StructType = schemas.EU_VALUE,
    framing: str = "lines",
    tz: str = "UTC",
    max_files: int | None = None,
    by: Sequence[str] = schemas.CALENDAR,
    available_now: bool = True,
) -> StreamingQuery:
    """Append rows to ``table`` and rejects to ``rejects``; each file is read once.

    A micro-batch gathers the rows of a day before it writes them.  Both tables are
    partitioned by ``batch`` too, so a batch that runs again replaces its own part.
    """

    def run(decoded: DataFrame, batch: int) -> None:
        rows, bad = split_messages(staged(decoded), tz)
        number = F.lit(batch).cast("long")
        append_partitioned(rows.withColumn("batch", number), table, (*by, "batch"), replace_touched=True)
        append_partitioned(bad.withColumn("batch", number), rejects, ("batch",), replace_touched=True, cluster=False)

    writer = (
        _decoded(spark, path, value_schema, framing, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = schemas.CALENDAR,
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream to a partitioned Parquet table, each input file exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
