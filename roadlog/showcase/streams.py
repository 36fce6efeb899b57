"""Streams over files, run until everything that is there has been read."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.showcase.documents import _APPLIED_SQL, customer_docs, order_actions
from roadlog.showcase.ingest import _LINE_ROWS, VALUE, message_files
from roadlog.showcase.registry import query
from roadlog.showcase.views import TELE_EVENTS, table, tele_events
from roadlog.sources.files import read_table
from roadlog.streaming import documents, ingest, rollups
from roadlog.workspace import new_folder

_DAY_TYPES = [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]
_READING = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("timestamp", T.LongType()), T.StructField("kmh", T.DoubleType())]
)


def _reading_files(spark, folder, copies: int = 1):
    """The events as a folder of Parquet files, written ``copies`` times."""
    path = new_folder(spark, "readings")
    rows = tele_events(spark, folder).select(*_READING.fieldNames())
    for _ in range(copies):
        rows.write.mode("append").parquet(path)
    return path


def _readings(spark, path):
    return rollups.with_event_time(spark.readStream.schema(_READING).parquet(path))


_INGEST_SCHEMA = T.StructType([*VALUE.fields, T.StructField("timestamp", T.LongType()), *_DAY_TYPES])


def _streamed(spark, folder):
    path = new_folder(spark, "streamed")
    ingest.start_ingest(
        spark, message_files(spark, folder), f"{path}/table", f"{path}/rejects", f"{path}/checkpoint", VALUE
    ).awaitTermination()
    return path


@query(_LINE_ROWS)
def stream_ingest(spark, folder):
    return read_table(spark, f"{_streamed(spark, folder)}/table").select(*_INGEST_SCHEMA.fieldNames())


@query(_LINE_ROWS)
def stream_ingest_rows(spark, folder):
    """The rows alone, by Spark's file sink."""
    path = new_folder(spark, "streamed")
    rows = ingest.stream_messages(spark, message_files(spark, folder), VALUE).rows.drop("extra")
    ingest.start_table(rows, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return read_table(spark, f"{path}/table", _INGEST_SCHEMA)


@query(
    """SELECT CASE event_type WHEN 'error' THEN 'malformed' ELSE 'missing value or timestamp' END AS reason,
  count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1"""
)
def stream_ingest_rejects(spark, folder):
    rejects = read_table(spark, f"{_streamed(spark, folder)}/rejects")
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


# the last day is still open: its end is after the watermark
@query(
    f"""WITH {TELE_EVENTS}
SELECT id, year, month, day, avg(kmh) AS kmh, count(*) AS count FROM tele_events
WHERE make_date(year, month, day) < (SELECT CAST(to_timestamp(max(timestamp) / 1000) AT TIME ZONE 'UTC' - INTERVAL 1 HOUR AS DATE) FROM tele_events)
GROUP BY id, year, month, day"""
)
def stream_daily(spark, folder):
    path = new_folder(spark, "daily")
    daily = rollups.stream_daily(_readings(spark, _reading_files(spark, folder)), ("id",), ["kmh"])
    ingest.start_table(daily, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            *_DAY_TYPES,
            T.StructField("kmh", T.DoubleType()),
            T.StructField("count", T.LongType()),
        ]
    )
    return read_table(spark, f"{path}/table", schema)


@query(f"WITH {TELE_EVENTS} SELECT id, timestamp, kmh FROM tele_events")
def stream_dedup(spark, folder):
    """Every reading delivered twice, each kept once."""
    path = new_folder(spark, "dedup")
    once = rollups.stream_dedup(_readings(spark, _reading_files(spark, folder, copies=2))).drop(rollups.EVENT_TIME)
    ingest.start_table(once, f"{path}/table", f"{path}/checkpoint", by=()).awaitTermination()
    return read_table(spark, f"{path}/table", _READING)


@query(
    f"""WITH {TELE_EVENTS}
SELECT id || '|' || year || '|' || month || '|' || day AS _id, max(kmh) AS kmh, count(*) AS count
FROM tele_events GROUP BY id, year, month, day"""
)
def stream_upsert(spark, folder):
    """Daily summaries as documents that are replaced as readings arrive."""
    path = new_folder(spark, "upsert")
    source = _reading_files(spark, folder)
    stream = rollups.with_event_time(
        spark.readStream.schema(_READING).option("maxFilesPerTrigger", 1).parquet(source)
    )
    daily = rollups.stream_daily(stream, ("id",), ["kmh"], "max", watermark="60 days")
    keys = ("id", "year", "month", "day")
    documents.start_upserts(daily, keys, f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return documents.current_documents(spark, f"{path}/log").select(
        "_id",
        F.get_json_object("source", "$.kmh").cast("double").alias("kmh"),
        F.get_json_object("source", "$.count").cast("long").alias("count"),
    )


def _bulk_text(actions):
    """Bulk lines of actions: the action line, then the source line unless deleted."""
    meta = F.struct("_index", "_id") if "_index" in actions.columns else F.struct("_id")
    line = F.to_json(F.create_map(F.coalesce("op", F.lit("index")), meta))
    return F.when(F.col("source").isNull(), line).otherwise(F.concat_ws("\n", line, "source"))


def _uploaded(spark, path, actions, name, order):
    """The actions as bulk files of at most 5000 actions, in order by name, in the log."""
    in_order = actions.repartitionByRange(*order).sortWithinPartitions(*order)
    in_order.select(_bulk_text(in_order).alias("value")).write.option("maxRecordsPerFile", 5000).text(
        f"{path}/in/{name}"
    )
    files = documents.stream_uploads(spark, f"{path}/in", max_files=100_000)
    documents.start_uploads(
        files, f"{path}/log", f"{path}/checkpoint", f"{path}/in", order=("file",)
    ).awaitTermination()


@query(
    f"""SELECT 'customers' AS _index, _id, name, status, total, last_key, last_priority FROM ({_APPLIED_SQL})"""
)
def stream_upload(spark, folder):
    """Bulk files (customers first, then all order actions) uploaded into a document log."""
    path = new_folder(spark, "upload")
    named = F.lit("customers").alias("_index")
    first = customer_docs(spark, folder).select(F.lit("index").alias("op"), named, "_id", "source")
    _uploaded(spark, path, first, "a customers.json", ["_id"])
    _uploaded(spark, path, order_actions(spark, folder).select("*", named), "orders+more.json", ["seq"])
    documents.compact_documents(spark, f"{path}/log", f"{path}/base", first=True)
    doc = F.parse_json("source")
    return documents.current_documents(spark, f"{path}/log", f"{path}/base").select(
        "_index",
        "_id",
        F.try_variant_get(doc, "$.c_name", "string").alias("name"),
        F.try_variant_get(doc, "$.status", "string").alias("status"),
        F.try_variant_get(doc, "$.total", "double").alias("total"),
        F.try_variant_get(doc, "$.last.key", "long").alias("last_key"),
        F.try_variant_get(doc, "$.last.priority", "string").alias("last_priority"),
    )


def _two_indices(spark, folder, path):
    """Every order twice, under its customer's id, in the indices of its status and priority."""
    rows = table(spark, folder, "orders").select(
        F.lit("index").alias("op"),
        F.explode(F.array("o_orderstatus", "o_orderpriority")).alias("_index"),
        F.col("o_custkey").cast("string").alias("_id"),
        F.to_json(F.struct("o_orderkey")).alias("source"),
        F.col("o_orderkey").alias("seq"),
    )
    for part, name in ((F.col("seq") % 2 == 0, "a even.json"), (F.col("seq") % 2 == 1, "b odd.json")):
        _uploaded(spark, path, rows.filter(part), name, ["seq"])


def _last_key():
    return F.get_json_object("source", "$.o_orderkey").cast("long").alias("last_key")


@query(
    """SELECT _index, CAST(o_custkey AS VARCHAR) AS _id,
  coalesce(max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 1), max(o_orderkey)) AS last_key
FROM (SELECT o_custkey, o_orderkey, o_orderstatus AS _index FROM orders
  UNION ALL SELECT o_custkey, o_orderkey, o_orderpriority FROM orders)
GROUP BY _index, o_custkey"""
)
def upload_same_id_two_indices(spark, folder):
    """Documents of different indices do not replace each other."""
    path = new_folder(spark, "indices")
    _two_indices(spark, folder, path)
    return documents.current_documents(spark, f"{path}/log").select("_index", "_id", _last_key())


@query(
    """SELECT o_orderstatus AS _index, CAST(o_custkey AS VARCHAR) AS _id,
  coalesce(max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 1), max(o_orderkey)) AS last_key
FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL"""
)
def compacted_by_index(spark, folder):
    """One index, from a base alone: the log that went into it is gone."""
    path = new_folder(spark, "indices")
    _two_indices(spark, folder, path)
    documents.compact_documents(spark, f"{path}/log", f"{path}/base", first=True, trim=True)
    return documents.current_documents(spark, f"{path}/log", f"{path}/base", "F").select("_index", "_id", _last_key())
