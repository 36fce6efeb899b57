"""Pages of a table by the sort values of the last row seen.

The table is written once in its order, in files of a bounded number of rows, with the
first and last sort values of each file beside them.  A page then reads the file that the
cursor falls into and the next ones until it is full, so page 10,000 costs what page 1
does, and a page does not change while others are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlog.operators.search import directed

ROWS_PER_FILE = 500_000


class Field(NamedTuple):
    """A sort field; missing values come last in both directions."""

    name: str
    descending: bool

    def sort(self, column: str | None = None) -> Column:
        return directed(F.col(column or f"`{self.name}`"), self.name, "desc" if self.descending else "asc")

    def behind(self, value: object, column: Column) -> Column:
        """Whether a value of the column comes after the given one."""
        if value is None:
            return F.lit(False)
        return (column < F.lit(value) if self.descending else column > F.lit(value)) | column.isNull()


def fields_of(sort: Sequence[str]) -> list[Field]:
    """``field``, ``field:asc`` or ``field:desc``."""
    found = []
    for item in sort:
        name, _, direction = item.partition(":")
        directed(F.col("x"), item, direction)  # says what is wrong with it
        found.append(Field(name, direction == "desc"))
    return found


def after(fields: Sequence[Field], values: Sequence, prefix: str = "") -> Column:
    """The rows behind the given sort values.

    Every part is a comparison of a column with a literal, so it reaches the scan.
    """
    if len(fields) != len(values):
        raise ValueError(f"a cursor needs {len(fields)} values, not {len(values)}")
    columns = [F.col(f"{prefix}`{f.name}`") for f in fields]
    ways = []
    for i, (field, value) in enumerate(zip(fields, values)):
        same = [c.eqNullSafe(F.lit(v)) for c, v in zip(columns[:i], values[:i])]
        ways.append(reduce(lambda a, b: a & b, [*same, field.behind(value, columns[i])]))
    return reduce(lambda a, b: a | b, ways)


def write_ordered(df: DataFrame, path: str, sort: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` in the order of ``sort``, which must tell every two rows apart (end
    it with the key) for cursors to miss none."""
    fields = fields_of(sort)
    order = [f.sort() for f in fields]
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.option("maxRecordsPerFile", rows_per_file)
        .parquet(f"{path}/rows")
    )
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    # in the order of the file, first and last are its ends
    number = F.col("_metadata.row_index")
    values = F.struct(*[F.col(f"`{f.name}`") for f in fields])
    ends = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min_by(values, number).alias("first"), F.max_by(values, number).alias("last")
    )
    ends.write.parquet(f"{path}/files")


def page(
    spark: SparkSession,
    path: str,
    sort: Sequence[str],
    cursor: Sequence | None = None,
    size: int = 1000,
    predicate: Column | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The ``size`` rows behind ``cursor`` (the sort values of the last row seen; None:
    from the start) of a table of :func:`write_ordered`, with the same ``sort``.

    With a predicate files are looked into, twice as many each time, until
    enough rows match.  A page passes the driver only as its file names.
    """
    fields = fields_of(sort)
    files = spark.read.parquet(f"{path}/files")
    schema = spark.read.parquet(f"{path}/rows").schema
    seen, look = 0, None
    if cursor is not None:
        files = files.filter(after(fields, cursor, "last."))
    order = [f.sort(f"first.`{f.name}`") for f in fields]
    while True:
        # every file has a row at least, so this many are always enough without a predicate
        most = size + 1 if look is None else look
        listed = files.orderBy(*order).select("file", "n").limit(most + 1).collect()
        chosen, held = [], 0
        for row in listed[:most]:
            chosen.append(row.file)
            # of the first file all but one row may be before the cursor
            held += row.n if chosen[1:] or cursor is None else 1
            if look is None and held >= size:
                break
        if not chosen:
            hits = spark.createDataFrame([], schema)
            break
        hits = spark.read.schema(schema).parquet(*chosen)
        if cursor is not None:
            hits = hits.filter(after(fields, cursor))
        if predicate is None:
            break
        hits = hits.filter(predicate)
        if len(chosen) == len(listed) or hits.limit(size).count() == size:
            break
        look = 2 * max(len(chosen), seen)
        seen = len(chosen)
    rows = hits.orderBy(*[f.sort() for f in fields]).limit(size)
    return rows.select(*columns) if columns else rows


class Pages:
    """All pages of a table of :func:`write_ordered`: one after the other, or numbered in one table."""

    def __init__(
        self, spark: SparkSession, path: str, sort: Sequence[str], size: int, predicate: Column | str | None
    ) -> None:
        self.spark, self.path, self.sort, self.size, self.predicate = spark, path, sort, size, predicate

    def __iter__(self) -> Iterator[DataFrame]:
        """Each page from where the one before ended; only the last row of each is looked at."""
        fields = fields_of(self.sort)
        cursor = None
        while True:
            found = page(self.spark, self.path, self.sort, cursor, self.size, self.predicate)
            # in the other direction the last row is the first
            last = found.withColumn("_n", F.monotonically_increasing_id()).orderBy(F.desc("_n")).select(
                *[F.col(f"`{f.name}`") for f in fields]
            ).head()
            if last is None:
                return
            yield found
            cursor = list(last)

    def numbered(self, name: str = "page") -> DataFrame:
        """The rows of all pages with the number of their page, from 1, in one pass over the files.

        The rows of the files before say at which place a file starts, so pages end where
        they would one after the other, and none waits for the one before.
        """
        fields = fields_of(self.sort)
        files = self.spark.read.parquet(f"{self.path}/files")
        schema = self.spark.read.parquet(f"{self.path}/rows").schema
        rows = (
            self.spark.read.schema(schema)
            .parquet(f"{self.path}/rows")
            .withColumns({"_file": F.col("_metadata.file_path"), "_number": F.col("_metadata.row_index")})
        )
        if self.predicate is not None:
            in_file = Window.partitionBy("_file").orderBy("_number")
            rows = rows.filter(self.predicate).withColumn("_number", F.row_number().over(in_file).cast("long") - 1)
            held = rows.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("n"))
            files = files.drop("n").join(held, "file")
        # a row a file
        order = [f.sort(f"{end}.`{f.name}`") for end in ("first", "last") for f in fields]
        earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        starts = files.select(F.col("file").alias("_file"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
        return rows.join(F.broadcast(starts), "_file").select(
            (F.expr(f"(_start + _number) div {int(self.size)}") + 1).alias(name),
            *[F.col(f"`{c}`") for c in schema.names],
        )


def pages(
    spark: SparkSession, path: str, sort: Sequence[str], size: int = 1000, predicate: Column | str | None = None
) -> Pages:
    """All pages of ``size`` rows (the last may have fewer)."""
    return Pages(spark, path, sort, size, predicate)
