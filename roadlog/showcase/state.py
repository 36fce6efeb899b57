"""Streams that remember for ever, run until everything that is there has been read."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlog.operators import search
from roadlog.showcase.nested import mixed_docs
from roadlog.showcase.registry import query
from roadlog.showcase.streams import _READING, _reading_files
from roadlog.showcase.views import TELE_EVENTS, tele_events
from roadlog.streaming import commits, state
from roadlog.workspace import new_folder


@query(f"WITH {TELE_EVENTS} SELECT id, timestamp, kmh FROM tele_events")
def stream_dedup_late(spark, folder):
    """Every reading delivered again in a batch of its own, long after a watermark would have passed."""
    path, source = new_folder(spark, "dedup-late"), _reading_files(spark, folder, copies=2)
    # and a third of them once more
    early = tele_events(spark, folder).select(*_READING.fieldNames())
    early.filter(F.col("timestamp") % 3 == 0).write.mode("append").parquet(source)
    stream = spark.readStream.schema(_READING).option("maxFilesPerTrigger", 8).parquet(source)
    state.start_dedup(stream, f"{path}/table", f"{path}/ledger", f"{path}/checkpoint").awaitTermination()
    return commits.read(spark, f"{path}/table", _READING).select(*_READING.fieldNames())


@query(
    f"""WITH {TELE_EVENTS}
SELECT id, year, month, day, avg(kmh) AS avg_kmh, min(kmh) AS min_kmh, max(kmh) AS max_kmh, count(*) AS rows
FROM tele_events GROUP BY id, year, month, day"""
)
def stream_daily_corrected(spark, folder):
    """Means and extremes of all days in one stream; every third reading comes after the others."""
    path, source = new_folder(spark, "corrected"), new_folder(spark, "readings")
    readings, keys, metrics = tele_events(spark, folder).select(*_READING.fieldNames()), [_READING["id"]], [_READING["kmh"]]

    def take(part):
        readings.filter(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(_READING).parquet(source)
        state.start_daily(stream, f"{path}/parts", f"{path}/checkpoint", ("id",), ("kmh",)).awaitTermination()

    late = F.xxhash64("id", "timestamp") % 3 == 0
    take(~late)
    state.compact_daily(spark, f"{path}/parts", keys, metrics)
    take(late)
    return state.daily(spark, f"{path}/parts", keys, metrics)


@query(
    """SELECT path, type, count(*) AS n FROM (
  SELECT 'conv' AS path, 'dict' AS type FROM conversations
  UNION ALL SELECT 'conv.turn', CASE WHEN conv_id % 3 = 0 THEN 'str' ELSE 'int' END FROM conversations
  UNION ALL SELECT 'conv.half', 'bool' FROM conversations WHERE conv_id % 3 = 0
  UNION ALL SELECT 'tags', 'list' FROM conversations WHERE conv_id % 5 <> 0)
GROUP BY path, type"""
)
def profile_incremental(spark, folder):
    """Documents profiled as their files land, in two runs."""
    path, source = new_folder(spark, "profile"), new_folder(spark, "documents")
    docs = mixed_docs(spark, folder)
    for half in (0, 1):
        docs.filter(F.col("conv_id") % 2 == half).select("doc").write.mode("append").text(source)
        state.start_profile(spark, source, f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return state.profile(spark, f"{path}/counts")


@query(
    """SELECT field, type, string_agg(idx, ',' ORDER BY idx) AS indices FROM (
  SELECT DISTINCT 'third' AS idx, 'conv.turn' AS field, 'str' AS type FROM conversations WHERE conv_id % 3 = 0
  UNION ALL SELECT DISTINCT 'others', 'conv.turn', 'int' FROM conversations WHERE conv_id % 3 <> 0
  UNION ALL SELECT DISTINCT 'third', 'conv.half', 'bool' FROM conversations WHERE conv_id % 3 = 0
  UNION ALL SELECT DISTINCT 'third', 'tags', 'list' FROM conversations WHERE conv_id % 3 = 0 AND conv_id % 5 <> 0
  UNION ALL SELECT DISTINCT 'others', 'tags', 'list' FROM conversations WHERE conv_id % 3 <> 0 AND conv_id % 5 <> 0
  UNION ALL SELECT DISTINCT CASE WHEN conv_id % 3 = 0 THEN 'third' ELSE 'others' END, 'conv', 'dict' FROM conversations
) GROUP BY field, type"""
)
def field_caps_by_index(spark, folder):
    """The fields of both indices of one table, in one pass."""
    index = F.when(F.col("conv_id") % 3 == 0, "third").otherwise("others")
    docs = mixed_docs(spark, folder).select(index.alias("_index"), F.col("doc").alias("source"))
    return search.field_caps(search.fields_by_index(docs)).withColumn("indices", F.array_join("indices", ","))
