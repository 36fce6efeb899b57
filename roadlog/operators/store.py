"""A document table of which only the buckets that change are written again.

Documents are laid out by ``pmod(hash(_index, _id), buckets)``.  A version of the table
is a manifest: one row a file, with the rows in it and a checksum.  A write puts the
buckets it touches into a folder of its own and commits a manifest that names those
files and, for all other buckets, the files there were.  Nothing that a manifest names is
changed, so a reader that has opened a version keeps it while others commit; older files
stay until :func:`vacuum`.

There is one writer at a time.  A version counts once its row in ``versions`` is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.operators.keyed import KEY, _index_of, apply_actions
from roadlog.workspace import remove_folder, written

BUCKETS = 64
# ids that are looked for by name in the files of their buckets
NAMED_IDS = 64

_VERSION_SCHEMA = "number long, folder string, buckets int, mark long, fields string"
_MANIFEST_SCHEMA = "bucket int, folder string, file string, n_rows long, checksum long"
_PLACE = r"(version=[^/]+/bucket=[0-9]+)/[^/]+$"


class Snapshot(NamedTuple):
    """A version that stays what it is."""

    root: str
    number: int
    folder: str
    buckets: int
    mark: int
    schema: T.StructType
    manifest: DataFrame


def bucket_of(buckets: int) -> Column:
    """The bucket of a document; ``_index`` must not be null."""
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def _named(df: DataFrame) -> DataFrame:
    """With ``_index`` (``""`` where there is none) and ``_id`` as text."""
    return df.withColumns({"_index": _index_of(df), "_id": F.col("_id").cast("string")})


# --- reading ------------------------------------------------------------------


def open_version(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """The newest version, or the one of that number."""
    versions = spark.read.schema(_VERSION_SCHEMA).parquet(f"{root}/versions")
    if number is not None:
        versions = versions.filter(F.col("number") == number)
    last = versions.agg(F.max_by(F.struct("*"), "number").alias("v")).first()["v"]
    if last is None:
        raise ValueError(f"no version {'' if number is None else number} in {root}")
    manifest = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{root}/manifests/{last.folder}")
    schema = T.StructType.fromJson(json.loads(last.fields))
    return Snapshot(root, last.number, last.folder, last.buckets, last.mark, schema, manifest)


def _folders(snapshot: Snapshot, buckets: Sequence[int] | None) -> list[str]:
    """One folder a bucket."""
    rows = snapshot.manifest
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(list(buckets)))
    return [r.folder for r in rows.select("folder").distinct().collect()]


def _read(snapshot: Snapshot, buckets: Sequence[int] | None = None) -> DataFrame:
    spark = snapshot.manifest.sparkSession
    folders = [f"{snapshot.root}/data/{f}" for f in _folders(snapshot, buckets)]
    schema = T.StructType([*snapshot.schema.fields, T.StructField("version", T.StringType()), T.StructField("bucket", T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{snapshot.root}/data").parquet(*folders)


def documents(snapshot: Snapshot, buckets: Sequence[int] | None = None) -> DataFrame:
    """The documents of the version, or of some of its buckets."""
    return _read(snapshot, buckets).select(*snapshot.schema.names)


def _by_file(rows: DataFrame, *more: Column) -> DataFrame:
    # the end of the path: version, bucket and name of the file
    path = F.regexp_extract("_metadata.file_path", _PLACE.replace("$", ""), 0)
    return rows.groupBy(path.alias("file")).agg(F.count("*").alias("found_rows"), *more)


def missing_files(snapshot: Snapshot, deep: bool = False) -> DataFrame:
    """``file, n_rows, found_rows`` of files that are not there, have other rows than the
    manifest says, or stand beside those of the manifest.

    Rows are counted from what the files say about themselves; ``deep`` reads them
    and compares checksums too.
    """
    rows = _read(snapshot)
    if "_metadata" not in _hidden(rows):
        found = snapshot.manifest.sparkSession.createDataFrame([], "file string, found_rows long, found_sum long")
    else:
        checksum = _checksum(snapshot.schema) if deep else F.lit(None).cast("long")
        found = _by_file(rows, checksum.alias("found_sum")) if deep else _by_file(rows).withColumn("found_sum", checksum)
    both = snapshot.manifest.join(found, "file", "full_outer")
    wrong = ~F.col("n_rows").eqNullSafe(F.col("found_rows"))
    if deep:
        wrong |= ~F.col("checksum").eqNullSafe(F.col("found_sum"))
    return both.filter(wrong).select("file", "n_rows", "found_rows")


def _hidden(rows: DataFrame) -> list[str]:
    """``_metadata`` where the rows come from files."""
    return ["_metadata"] if rows.inputFiles() else []


def _checksum(schema: T.StructType) -> Column:
    values = [F.to_json(c) if isinstance(schema[c].dataType, T.VariantType) else F.col(c) for c in schema.names]
    return F.bit_xor(F.xxhash64(*values))


def scan(snapshot: Snapshot, predicate: Column | str | None = None, complete: bool = True) -> DataFrame:
    """Every matching document of the version.

    With ``complete`` the job fails when a file of the manifest is missing, is
    short, or has company: the rows of each file are counted beside the scan.
    Without, what is there is read (:func:`missing_files` tells what is not).
    """
    rows = documents(snapshot)
    if complete:
        problems = missing_files(snapshot).agg(
            F.count("*").alias("n"), F.min(F.struct("file", "n_rows", "found_rows")).alias("first")
        )
        message = F.concat(
            F.lit("incomplete scan: "), F.col("n"), F.lit(" of the files differ from the manifest, as "), F.to_json("first")
        )
        whole = problems.select(F.when(F.col("n") == 0, True).otherwise(F.raise_error(message).cast("boolean")))
        rows = rows.filter(whole.scalar())
    return rows if predicate is None else rows.filter(predicate)


# --- writing ------------------------------------------------------------------


def _commit(
    snapshot: Snapshot | None, docs: DataFrame, root: str, buckets: int, touched: Sequence[int] | None, mark: int
) -> Snapshot:
    """Write ``docs`` as the contents of the touched buckets (None: of all)."""
    spark = docs.sparkSession
    number = 0 if snapshot is None else snapshot.number + 1
    folder = f"{number}-{uuid.uuid4().hex[:8]}"
    (
        docs.withColumns({"version": F.lit(folder), "bucket": bucket_of(buckets)})
        .repartition("bucket")
        .sortWithinPartitions("bucket", *KEY)
        .write.partitionBy("version", "bucket")
        .option("parquet.bloom.filter.enabled#_id", "true")
        # else the filter is made for a million ids in every file
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .mode("append")
        .parquet(f"{root}/data")
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    made = _files_of(spark, root, folder, schema)
    if snapshot is not None and touched is not None:
        kept = snapshot.manifest.filter(~F.col("bucket").isin(list(touched)))
        made = kept.unionByName(made)
    # few rows: one a file
    made.coalesce(1).write.parquet(f"{root}/manifests/{folder}")
    row = (number, folder, buckets, mark, schema.json())
    spark.createDataFrame([row], _VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return open_version(spark, root, number)


def _files_of(spark: SparkSession, root: str, folder: str, schema: T.StructType) -> DataFrame:
    """The manifest rows of a folder that has just been written."""
    path = f"{root}/data/version={folder}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _MANIFEST_SCHEMA)
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(whole).option("basePath", path).parquet(path)
    place = F.regexp_extract("file", _PLACE, 1)
    return _by_file(rows, _checksum(schema).alias("checksum")).select(
        F.regexp_extract("file", "bucket=([0-9]+)/", 1).cast("int").alias("bucket"),
        place.alias("folder"),
        "file",
        F.col("found_rows").alias("n_rows"),
        "checksum",
    )


def create(docs: DataFrame, root: str, buckets: int = BUCKETS, mark: int = -1) -> Snapshot:
    """Lay out a document table ``(_index, _id, source, ...)``; ids must be unique.

    A bucket is rewritten as a whole and by one task, so ``buckets`` should leave
    some 100 MB in each.  ``mark`` is a number that is kept with the version.
    """
    return _commit(None, _named(docs), root, buckets, None, mark)


def touched_buckets(names: DataFrame, buckets: int) -> list[int]:
    """The buckets of documents named by ``KEY``: at most as many numbers as there are buckets."""
    return sorted(r.bucket for r in names.select(bucket_of(buckets).alias("bucket")).distinct().collect())


def merge(
    spark: SparkSession, root: str, actions: DataFrame, order: Sequence[str] = ("seq",), mark: int | None = None
) -> Snapshot:
    """Apply bulk actions and commit a version; only the buckets of the documents they
    name are read and written.

    An ``index`` or ``create`` without id gets one of its own.
    """
    snapshot = open_version(spark, root)
    own = F.when(F.coalesce("op", F.lit("index")).isin("index", "create"), F.uuid())
    acts = written(_named(actions).withColumn("_id", F.coalesce("_id", own)), "merged-actions")
    touched = touched_buckets(acts.filter(F.col("_id").isNotNull()), snapshot.buckets)
    old = documents(snapshot, touched)
    changed = apply_actions(old, acts, order).table.select(*KEY, "source")
    extra = [c for c in snapshot.schema.names if c not in (*KEY, "source")]
    if extra:
        # further columns stay with their documents
        changed = changed.join(old.select(*KEY, *extra), list(KEY), "left")
    return _commit(
        snapshot, changed.select(*snapshot.schema.names), root, snapshot.buckets, touched,
        snapshot.mark if mark is None else mark,
    )


def vacuum(spark: SparkSession, root: str) -> None:
    """Remove the files that only older versions name; readers of those lose them."""
    newest = open_version(spark, root)
    versions = spark.read.schema(_VERSION_SCHEMA).parquet(f"{root}/versions")
    # a row a version, and of each the folders of buckets written since
    older = [r.folder for r in versions.filter(F.col("number") < newest.number).select("folder").collect()]
    live = {r.folder for r in newest.manifest.select("folder").distinct().collect()}
    for folder in older:
        path = f"{root}/manifests/{folder}"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            continue
        named = spark.read.schema(_MANIFEST_SCHEMA).parquet(path).select("folder").distinct().collect()
        for dead in {r.folder for r in named} - live:
            remove_folder(spark, f"{root}/data/{dead}")
        remove_folder(spark, path)


# --- lookups ------------------------------------------------------------------


def lookup(snapshot: Snapshot, ids: DataFrame) -> DataFrame:
    """One row per requested ``(_index, _id)``, repeats included: the document and ``found``.

    Only the buckets of the ids are read.  Up to ``NAMED_IDS`` ids are also told to
    the scan, which then skips what the statistics and Bloom filters of its files rule out.
    """
    wanted = _named(ids).select(*KEY)
    asked = wanted.filter(F.col("_id").isNotNull())
    hits = documents(snapshot, touched_buckets(asked, snapshot.buckets))
    few = asked.select("_id").distinct().limit(NAMED_IDS + 1).collect()
    if len(few) <= NAMED_IDS:
        hits = hits.filter(F.col("_id").isin([r._id for r in few]))
    return wanted.join(hits.withColumn("found", F.lit(True)), list(KEY), "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def exists(snapshot: Snapshot, ids: DataFrame) -> DataFrame:
    """``_index, _id, found`` for each requested name; sources are not read."""
    return lookup(snapshot, ids).select(*KEY, "found")
