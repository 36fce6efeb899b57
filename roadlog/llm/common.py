"""What the operators share: inputs, batches of rows in Python, row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# white space of the word rules: blank, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"

# rows whose results are held in Python at once
SLICE = 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` only, null texts as empty ones."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def utf8_size(c: Column | str) -> Column:
    """Bytes of a text in UTF-8 (a long)."""
    return F.octet_length(c).cast("long")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], schema: str
) -> DataFrame:
    """``fn`` over Arrow batches; it returns one array for each column of ``schema``."""
    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                yield pa.RecordBatch.from_arrays(fn(batch.slice(start, SLICE)), names=names)

    return df.mapInArrow(run, schema)


def utf8_bytes(column: pa.Array) -> Iterator[bytes]:
    """The texts of a batch as UTF-8, one at a time."""
    for value in column.cast(pa.binary()):
        yield value.as_py()
