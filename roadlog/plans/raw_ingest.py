"""Raw messages to a date-partitioned table, with a sample as bulk lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadlog import schemas
from roadlog.operators.rollups import first_rows
from roadlog.sinks.tables import append_partitioned, write_bulk_file
from roadlog.sources.messages import read_messages

# rows in the sample of an ingest
SAMPLE_ROWS = 200


def ingest_messages(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    sample: str | None = None,
    value_schema: T.StructType = schemas.EU_VALUE,
    framing: str = "lines",
    tz: str = "UTC",
    sample_rows: int = SAMPLE_ROWS,
    replace_touched: bool = False,
    cluster: bool = False,
    sample_order: Sequence[str] | None = None,
) -> DataFrame:
    """Append the messages below the paths to ``table`` and return the rejects.

    The files are read and decoded once; table, sample and rejects come from the
    decoded messages in the shared folder (``roadlog.workspace.clear`` removes
    them when the rejects are done with).  ``sample`` names a bulk file for the first rows.  Without ``sample_order``
    they are the first that are read, which touches few files; with it they are
    the first in that order, which takes another pass.  Message files
    usually belong to one day, so rows are written where they were read;
    ``cluster`` gathers them by day first when they do not.
    """
    messages = read_messages(spark, paths, value_schema, framing, tz=tz, once=True)
    append_partitioned(messages.rows, table, schemas.CALENDAR, replace_touched, cluster)
    if sample is not None:
        if sample_order is None:
            first = messages.rows.limit(sample_rows)
        else:
            first = first_rows(messages.rows, sample_rows, sample_order)
        write_bulk_file(first, sample, ("id", "timestamp"))
    return messages.rejects
