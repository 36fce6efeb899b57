"""Document tables fed by streams.

A stream appends its actions to a log, ``(batch, number, pair, op, _index, _id,
source)``, one folder per micro-batch; the first three columns are the order of
the actions (micro-batch, file in it, action in the file).  A batch that runs
again overwrites its own folder, so a replay changes nothing, and no batch ever
rewrites older data.  The documents, named by ``(_index, _id)``, are what
:func:`roadlog.operators.keyed.apply_actions` makes of base and log.  The base is a
bucketed table (:mod:`roadlog.operators.store`): :func:`compact_documents` merges the log
into the buckets it touches from time to time, and can then drop what only older versions
need and the part of the log that went in.  Readers apply the rest of the log to
the buckets it touches and take the others as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlog.functions.columns import index_from_file_path
from roadlog.operators import store
from roadlog.operators.documents import document_ids
from roadlog.operators.keyed import apply_actions
from roadlog.operators.ordered import positions
from roadlog.workspace import remove_folder

LOG_SCHEMA = "number long, pair long, op string, _index string, _id string, source string, batch long"
LOG_ORDER = ("batch", "number", "pair")
BASE_SCHEMA = "_index string, _id string, source string"
BASE_NAMES = ("_index", "_id", "source")


# --- uploads ------------------------------------------------------------------

PAIR_SCHEMA = "file string, pair long, op string, _index string, _id string, source string, error string"


def _pairs_of_file(text: str) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """``(op, index, id, source)`` of the action lines of a bulk file.

    Every line must be JSON.  A ``delete`` has no source line.
    """
    decoded = iter([(line, json.loads(line)) for line in text.splitlines()])
    for line, action in decoded:
        if not isinstance(action, dict) or len(action) != 1:
            raise ValueError(f"not an action line: {line[:200]}")
        ((op, meta),) = action.items()
        source = None
        if op != "delete":
            source, _ = next(decoded, (None, None))
            if source is None:
                raise ValueError("the last action has no source line")
        doc_id = meta.get("_id")
        yield op, meta.get("_index"), None if doc_id is None else str(doc_id), source


def bulk_file_actions(files: DataFrame, root: str | None = None, strict: bool = True) -> DataFrame:
    """Actions of whole bulk files ``(file, value)``, in columns ``PAIR_SCHEMA``.

    The index is the action's own or follows from the file name.  A file with a
    blank or broken line fails the job (``strict``) or gives a single row that
    carries the ``error``.
    """

    def cut(batches):
        for batch in batches:
            for file, index, text in batch[["file", "index", "value"]].itertuples(index=False):
                try:
                    rows = [
                        (file, i, op, own or index, doc_id, source, None)
                        for i, (op, own, doc_id, source) in enumerate(_pairs_of_file(text))
                    ]
                except ValueError as e:
                    if strict:
                        raise ValueError(f"{file}: {e}") from e
                    rows = [(file, 0, None, index, None, None, str(e))]
                if rows:
                    yield pd.DataFrame(
                        rows, columns=["file", "pair", "op", "_index", "_id", "source", "error"], dtype=object
                    )

    named = files.select("file", index_from_file_path(F.col("file"), root).alias("index"), "value")
    return named.mapInPandas(cut, PAIR_SCHEMA)


def stream_uploads(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Streaming ``(file, modified, value)``: each landed bulk file as one row.

    Meant for the moderate files that an event-driven upload handles.
    """
    return (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("modified"),
            "value",
        )
    )


def _write_batch(actions: DataFrame, batch: int, log: str) -> None:
    (
        actions.withColumn("batch", F.lit(batch).cast("long"))
        .select("number", "pair", "op", "_index", "_id", "source", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(log)
    )


def start_uploads(
    files: DataFrame,
    log: str,
    checkpoint: str,
    root: str | None = None,
    rejects: str | None = None,
    order: Sequence[str] = ("modified", "file"),
    available_now: bool = True,
) -> StreamingQuery:
    """Append the actions of landed bulk files to a document log.

    Files of one micro-batch apply in ``order``: by modification time, or by
    ``("file",)`` where the names tell.  Spark itself forms the micro-batches
    from the oldest files first.  With ``rejects`` broken files are written there and the others go on;
    without, a broken file fails the stream.
    """

    def run(batch_files: DataFrame, batch: int) -> None:
        numbers = positions(batch_files.select("file", "modified"), order, "number")
        actions = bulk_file_actions(batch_files, root, strict=rejects is None)
        if rejects is not None:
            (
                actions.filter(F.col("error").isNotNull())
                .select("file", "error", F.lit(batch).cast("long").alias("batch"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(rejects)
            )
            actions = actions.filter(F.col("error").isNull())
        _write_batch(actions.join(numbers.select("file", "number"), "file"), batch, log)

    writer = files.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# --- summaries ----------------------------------------------------------------


def start_upserts(
    summaries: DataFrame,
    keys: Sequence[str],
    log: str,
    checkpoint: str,
    index: str | None = None,
    sep: str = "|",
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a document per key up to date with a streaming aggregate.

    The aggregate runs in update mode: a batch brings each changed key once.
    """

    def run(changed: DataFrame, batch: int) -> None:
        docs = document_ids(changed, keys, sep).select(
            F.lit(0).cast("long").alias("number"),
            F.lit(0).cast("long").alias("pair"),
            F.lit("index").alias("op"),
            F.lit(index).cast("string").alias("_index"),
            "_id",
            "source",
        )
        _write_batch(docs, batch, log)

    writer = (
        summaries.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# --- reading ------------------------------------------------------------------


def logged_actions(spark: SparkSession, log: str) -> DataFrame:
    """The actions of a log; ``LOG_ORDER`` names the columns of their order."""
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def current_documents(
    spark: SparkSession,
    log: str,
    base: str | None = None,
    index: str | None = None,
    upto: int | None = None,
) -> DataFrame:
    """``(_index, _id, source)`` after every logged action; ``index`` picks one index.

    ``upto`` leaves out later batches.  Of a base only the newest version is read, of
    the log only the batches after it, and only the buckets that those name meet the
    actions.
    """
    snapshot = None if base is None else store.open_version(spark, base)
    actions = logged_actions(spark, log)
    if snapshot is not None:
        actions = actions.filter(F.col("batch") > snapshot.mark)
    if upto is not None:
        actions = actions.filter(F.col("batch") <= upto)
    if index is not None:
        actions = actions.filter(F.col("_index") == index)
    if snapshot is None:
        return apply_actions(spark.createDataFrame([], BASE_SCHEMA), actions, LOG_ORDER).table

    def old(buckets: list[int]) -> DataFrame:
        docs = store.documents(snapshot, buckets)
        return docs if index is None else docs.filter(F.col("_index") == index)

    names = actions.filter(F.col("_id").isNotNull()).select(F.coalesce("_index", F.lit("")).alias("_index"), "_id")
    touched = store.touched_buckets(names, snapshot.buckets)
    others = [b for b in range(snapshot.buckets) if b not in set(touched)]
    merged = apply_actions(old(touched), actions, LOG_ORDER).table
    return merged.select(*BASE_NAMES).unionByName(old(others).select(*BASE_NAMES))


def compact_documents(
    spark: SparkSession,
    log: str,
    base: str,
    first: bool = False,
    trim: bool = False,
    buckets: int = store.BUCKETS,
) -> None:
    """Merge the log into the base; ``first`` makes a base of so many ``buckets``.

    Only buckets that the log touches are read and written.  Run it between
    batches: a batch that is just being written would count as complete.
    ``trim`` then removes what only older versions need and the batches that went in;
    without it they are left as they are.
    """
    if first:
        store.create(spark.createDataFrame([], BASE_SCHEMA), base, buckets)
    done = store.open_version(spark, base).mark
    upto = spark.read.schema(LOG_SCHEMA).parquet(log).agg(F.max("batch")).first()[0]
    if upto is None or upto <= done:
        return
    fresh = logged_actions(spark, log).filter((F.col("batch") > done) & (F.col("batch") <= upto))
    store.merge(spark, base, fresh, LOG_ORDER, mark=upto)
    if trim:
        store.vacuum(spark, base)
        batches = spark.read.schema(LOG_SCHEMA).parquet(log).filter(F.col("batch") <= upto).select("batch").distinct()
        # one number a micro-batch
        for row in batches.collect():
            remove_folder(spark, f"{log}/batch={row.batch}")
