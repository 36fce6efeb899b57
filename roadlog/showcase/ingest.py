"""Message files, format readers and writers.

The files are written from the tables into the shared folder first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.operators.documents import bulk_pairs
from roadlog.plans.raw_ingest import ingest_messages
from roadlog.showcase.registry import query, undotted
from roadlog.showcase.views import TELE_EVENTS, table, tele_events
from roadlog.sinks import tables as sinks
from roadlog.sources import files, messages
from roadlog.streaming.rollups import dedup, rebuild_days
from roadlog.workspace import new_folder

VALUE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("kmh", T.DoubleType()),
        T.StructField("rpm", T.DoubleType()),
        T.StructField("breakActive", T.BooleanType()),
    ]
)
_FIELDS = ", ".join([*VALUE.fieldNames(), "timestamp", "year", "month", "day"])


def raw_messages(spark, folder):
    """``(file bucket, value)``: one message per event.

    By event type, messages are plain (``view``, ``click``), contain a blank
    (``purchase``), are cut off (``error``) or lack their value (``signup``).
    """
    rows = tele_events(spark, folder)
    value = F.struct(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("model") == "purchase", "purchase order").otherwise(F.col("model")).alias("model"),
        "kmh",
        "rpm",
        "breakActive",
        F.lit(0).alias("timestamp"),
    )
    message = F.to_json(F.struct("timestamp", F.when(F.col("model") != "signup", value).alias("value")))
    cut = F.substring(message, 1, 20)
    bucket = F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd--HH")
    return rows.select(bucket.alias("bucket"), F.when(F.col("model") == "error", cut).otherwise(message).alias("value"))


def message_files(spark, folder):
    path = new_folder(spark, "messages")
    raw_messages(spark, folder).select("value").write.text(path)
    return path


def _rows_sql(kept: str) -> str:
    return f"""WITH {TELE_EVENTS}
SELECT CAST(id AS VARCHAR) AS id, CASE WHEN model = 'purchase' THEN 'purchase order' ELSE model END AS model,
  kmh, rpm, breakActive, timestamp, year, month, day FROM tele_events WHERE model IN ({kept})"""


_LINE_ROWS = _rows_sql("'view', 'click', 'purchase'")


@query(_LINE_ROWS)
def ingest_lines(spark, folder):
    return messages.read_messages(spark, message_files(spark, folder), VALUE, extra=False).rows


@query(_rows_sql("'view', 'click'"))
def ingest_tokens(spark, folder):
    return messages.read_messages(spark, message_files(spark, folder), VALUE, framing="tokens", extra=False).rows


@query(
    """SELECT CASE event_type WHEN 'error' THEN 'malformed' ELSE 'missing value or timestamp' END AS reason,
  count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1"""
)
def ingest_rejects(spark, folder):
    rejects = messages.read_messages(spark, message_files(spark, folder), VALUE).rejects
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""SELECT bucket, count(*) AS n, sum(kmh) AS kmh FROM (
  SELECT strftime(to_timestamp(timestamp / 1000) AT TIME ZONE 'UTC', '%Y-%m-%d--%H') AS bucket, kmh FROM ({_LINE_ROWS})
) GROUP BY bucket"""
)
def ingest_hour_buckets(spark, folder):
    path = new_folder(spark, "buckets")
    raw = raw_messages(spark, folder).withColumn("hour", F.col("bucket"))
    # nested folders car=1/hour=<bucket>, found by the recursive scan
    gathered = raw.select(F.lit(1).alias("car"), "hour", "value").hint("rebalance", "hour")
    gathered.write.partitionBy("car", "hour").text(path)
    rows = messages.read_hour_buckets(spark, path, VALUE)
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("kmh").alias("kmh"))


@query(_LINE_ROWS)
def ingest_job(spark, folder):
    """The whole ingest job, read back from its table."""
    out = new_folder(spark, "ingested")
    ingest_messages(
        spark, message_files(spark, folder), f"{out}/table", f"{out}/sample", VALUE, cluster=True
    )
    fields = _FIELDS.split(", ")
    schema = T.StructType(
        [*VALUE.fields, T.StructField("timestamp", T.LongType())]
        + [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]
    )
    return files.read_table(spark, f"{out}/table", schema).select(*fields)


@query(
    f"""SELECT '{{"index":{{"_id":"' || id || '|' || timestamp || '"}}}}' AS action,
  CAST(kmh AS DOUBLE) AS kmh, year FROM ({_LINE_ROWS}) ORDER BY timestamp, id LIMIT 200"""
)
def ingest_sample(spark, folder):
    """The 200-row bulk file of the ingest job, its lines paired again by id."""
    out = new_folder(spark, "ingested")
    ingest_messages(
        spark,
        message_files(spark, folder),
        f"{out}/table",
        f"{out}/sample",
        VALUE,
        sample_order=("timestamp", "id"),
    )
    pairs = spark.read.text(f"{out}/sample", lineSep='{"index"').filter("value != ''")
    lines = F.split("value", "\n")
    return pairs.select(
        F.concat(F.lit('{"index"'), lines[0]).alias("action"),
        F.get_json_object(lines[1], "$.kmh").cast("double").alias("kmh"),
        F.get_json_object(lines[1], "$.year").cast("int").alias("year"),
    )


def _odd_files(spark, folder):
    """Messages with a tab around, a decimal point in the timestamp, a value of a wrong
    type, fields the schema does not name, and lines that are no messages."""
    path = new_folder(spark, "odd")
    rows = table(spark, folder, "events")
    n = F.col("event_id")
    value = F.struct(
        n.cast("string").alias("id"),
        F.when(n % 5 == 1, F.lit("fast")).otherwise(F.col("value").cast("string")).alias("kmh"),
        F.when(n % 3 == 0, F.struct(F.col("user_id").alias("user"))).alias("driver"),
    )
    # kmh as a number unless it is the word
    text = F.regexp_replace(F.to_json(value), r'"kmh":"([-0-9.E]+)"', '"kmh":$1')
    milliseconds = F.concat(F.unix_millis(F.col("ts").cast("timestamp")), F.when(n % 2 == 0, ".0").otherwise(""))
    message = F.concat(F.lit('{"timestamp":'), milliseconds, F.lit(',"value":'), text, F.lit("}"))
    line = (
        F.when(n % 11 == 0, F.lit("12"))
        .when(n % 11 == 1, F.substring(message, 1, 30))
        .when(n % 7 == 0, F.concat(F.lit("\t"), message, F.lit(" \t")))
        .otherwise(message)
    )
    rows.select(line.alias("value")).write.text(path)
    return path


@query(
    """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 5 <> 1 THEN value END AS kmh,
  epoch_us(ts) // 1000 AS timestamp, CAST(day(ts) AS INTEGER) AS day,
  CASE WHEN event_id % 5 = 1 THEN 'fast' END AS word, CASE WHEN event_id % 3 = 0 THEN user_id END AS driver
FROM events WHERE event_id % 11 > 1"""
)
def ingest_awkward(spark, folder):
    """Every message arrives, with what has no column beside it."""
    rows = messages.read_messages(spark, _odd_files(spark, folder), VALUE, once=True).rows
    return rows.select(
        "id",
        "kmh",
        "timestamp",
        "day",
        F.try_variant_get("extra", "$.kmh", "string").alias("word"),
        F.try_variant_get("extra", "$.driver.user", "long").alias("driver"),
    )


@query(
    """SELECT CASE event_id % 11 WHEN 0 THEN 'not an envelope' ELSE 'malformed' END AS reason, count(*) AS n
FROM events WHERE event_id % 11 < 2 GROUP BY 1"""
)
def ingest_awkward_rejects(spark, folder):
    rejects = messages.read_messages(spark, _odd_files(spark, folder), VALUE, once=True).rejects
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM events WHERE event_type NOT IN ('error', 'signup')")
def ingest_strict(spark, folder):
    """The strict mode accepts messages that are only cut off."""
    path = message_files(spark, folder)
    whole = spark.read.text(path).filter(F.get_json_object("value", "$.value").isNotNull() | ~F.endswith("value", F.lit("}")))
    strict_path = new_folder(spark, "strict")
    whole.write.text(strict_path)
    read = messages.read_messages(spark, strict_path, VALUE, once=True)
    return messages.require_envelopes(read).agg(F.count("*").alias("n"))


# --- formats ------------------------------------------------------------------

_NESTED = "event_id LONG, who STRUCT<user: LONG>, what STRUCT<type: STRING, value: DOUBLE>"


@query(
    """SELECT event_id, user_id AS who_user, event_type AS what_type, value AS what_value,
  2021 AS year, 8 AS month, 6 AS day FROM events"""
)
def json_lines_calendar(spark, folder):
    path = new_folder(spark, "jsonl")
    shaped = table(spark, folder, "events").select(
        "event_id",
        F.struct(F.col("user_id").alias("user")).alias("who"),
        F.struct(F.col("event_type").alias("type"), "value").alias("what"),
    )
    sinks.write_json_lines(shaped, path)
    schema = T.StructType.fromDDL(_NESTED)
    return undotted(files.read_json_lines_table(spark, path, schema=schema, date=dt.date(2021, 8, 6)))


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS what_type FROM events""")
def json_lines_paths(spark, folder):
    path = new_folder(spark, "jsonl")
    shaped = table(spark, folder, "events").select("event_id", F.struct(F.col("event_type").alias("type")).alias("what"))
    sinks.write_json_lines(shaped, path)
    return undotted(files.read_json_lines_table(spark, path, paths=["event_id", "what.type"]))


@query("SELECT CAST(day(ts) AS BIGINT) AS day, count(*) AS n, max(value) AS value FROM events GROUP BY 1")
def json_documents(spark, folder):
    """One JSON document per file: a folder per day with one file each."""
    path = new_folder(spark, "documents")
    per_day = table(spark, folder, "events").groupBy(F.dayofmonth("ts").alias("day")).agg(
        F.count("*").alias("n"), F.max("value").alias("value")
    )
    doc = F.to_json(F.struct("day", "n", "value"))
    per_day.select(F.col("day").alias("d"), doc.alias("value")).write.partitionBy("d").text(path)
    docs = files.read_json_documents(spark, f"{path}/*")
    return docs.select(
        F.variant_get("doc", "$.day", "long").alias("day"),
        F.variant_get("doc", "$.n", "long").alias("n"),
        F.variant_get("doc", "$.value", "double").alias("value"),
    )


_ORDERS = "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders"


def _as_text(df):
    """The time as text, for the comparison."""
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query(_ORDERS)
def csv_roundtrip(spark, folder):
    path = new_folder(spark, "csv")
    rows = table(spark, folder, "orders")
    rows.write.csv(f"{path}/csv", header=True)
    sinks.csv_to_parquet(spark, f"{path}/csv", f"{path}/parquet", rows.schema)
    return _as_text(files.read_any(spark, f"{path}/parquet", "parquet", rows.schema))


@query("SELECT doc_id, 'say \"' || source || '\", ok' AS quoted, text, lang FROM documents")
def csv_quoted(spark, folder):
    """Quotes, commas and line feeds, as other programs write them."""
    path = new_folder(spark, "csv")
    rows = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit('say "'), "source", F.lit('", ok')).alias("quoted"), "text", "lang"
    )

    def field(c):
        return F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))

    lines = rows.select(F.concat_ws(",", *[field(c) for c in rows.columns]).alias("line"))
    # written as text, every part with a header of its own: the lines of a part are told
    # apart by their number in it
    numbered = lines.withColumn("first", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0)
    header = F.array(F.lit(",".join(rows.columns)), F.col("line"))
    with_header = numbered.select(F.explode(F.when(F.col("first"), header).otherwise(F.array("line"))).alias("value"))
    with_header.write.text(path)
    return files.read_csv(spark, path, rows.schema)


@query("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark, folder):
    path = new_folder(spark, "csv")
    table(spark, folder, "customer").write.csv(path, header=True)
    return files.read_csv(spark, path)


@query(
    """SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate),
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""
)
def parquet_roundtrip(spark, folder):
    path = new_folder(spark, "parquet")
    rows = table(spark, folder, "orders")
    sinks.append_partitioned(
        rows.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}), path, ("year", "month")
    )
    return _as_text(files.read_table(spark, path))


@query(f"{_ORDERS} UNION ALL {_ORDERS}")
def append_twice(spark, folder):
    path = new_folder(spark, "appended")
    rows = table(spark, folder, "orders")
    sinks.append_table(rows, path)
    sinks.append_table(rows, path)
    return _as_text(files.read_table(spark, path, rows.schema))


@query(_ORDERS)
def replace_touched_partitions(spark, folder):
    path = new_folder(spark, "replaced")
    rows = table(spark, folder, "orders")
    for _ in range(2):
        sinks.append_partitioned(rows, path, ("o_orderpriority",), replace_touched=True)
    return _as_text(files.read_table(spark, path, rows.schema))


@query(_ORDERS)
def jsonl_roundtrip(spark, folder):
    path = new_folder(spark, "jsonl")
    rows = table(spark, folder, "orders")
    sinks.write_json_lines(rows, path)
    return _as_text(files.read_any(spark, path, "json_lines", rows.schema))


def _odd_lines(spark, folder):
    """Order lines of which some are cut and some have a word for a number."""
    path = new_folder(spark, "jsonl")
    key = F.col("o_orderkey")
    good = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    word = F.to_json(F.struct("o_orderkey", F.lit("much").alias("o_totalprice")))
    line = F.when(key % 9 == 0, F.substring(good, 1, 12)).when(key % 9 == 1, word).otherwise(good)
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    return files.checked_json_lines(spark, path, "o_orderkey LONG, o_totalprice DOUBLE")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 1 THEN o_totalprice END AS o_totalprice, 'row' AS kind
FROM orders WHERE o_orderkey % 9 <> 0
UNION ALL SELECT CAST(count(*) AS BIGINT), NULL, CASE o_orderkey % 9 WHEN 0 THEN 'malformed' ELSE 'schema mismatch' END
FROM orders WHERE o_orderkey % 9 < 2 GROUP BY 3"""
)
def jsonl_with_rejects(spark, folder):
    checked = _odd_lines(spark, folder)
    rejects = checked.rejects.groupBy("reason").agg(F.count("*").alias("o_orderkey"))
    return checked.rows.withColumn("kind", F.lit("row")).unionByName(
        rejects.select("o_orderkey", F.lit(None).cast("double").alias("o_totalprice"), F.col("reason").alias("kind"))
    )


@query("SELECT count(*) AS n, count(*) AS keys FROM orders WHERE o_orderkey % 9 <> 0")
def jsonl_same_rows_for_any_columns(spark, folder):
    rows = _odd_lines(spark, folder).rows
    keys = rows.select("o_orderkey").agg(F.count("o_orderkey")).scalar()
    return rows.agg(F.count("*").alias("n")).withColumn("keys", keys)


def _document_files(spark, folder, indented):
    """JSON files that hold an array of up to fifty documents, over many lines."""
    path = new_folder(spark, "json")
    gap = "\n  " if indented else ""
    element = F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars"))
    arrays = (
        table(spark, folder, "documents")
        .groupBy(F.floor(F.col("doc_id") / 50).alias("file"))
        .agg(F.concat(F.lit(f"[{gap}"), F.array_join(F.collect_list(element), f",{gap}"), F.lit("]")).alias("value"))
    )
    # an array a file, all in one folder
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_roundtrip(spark, folder):
    """Whole texts through JSON documents and back."""
    schema = table(spark, folder, "documents").schema
    return files.read_any(spark, _document_files(spark, folder, True), "json", schema)


@query("SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY lang")
def json_documents_array(spark, folder):
    """Arrays of documents, their types inferred."""
    rows = files.read_any(spark, _document_files(spark, folder, False), "json")
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query("SELECT p_name AS line, count(*) AS n FROM part GROUP BY p_name")
def text_roundtrip(spark, folder):
    path = new_folder(spark, "text")
    sinks.write_text(table(spark, folder, "part"), path, "p_name")
    lines = messages.text_lines(spark, path)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query(
    """SELECT '{"index":{"_id":"' || c_custkey || '"}}' AS action,
  '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS source FROM customer"""
)
def bulk_file(spark, folder):
    path = new_folder(spark, "bulk")
    rows = table(spark, folder, "customer").select("c_custkey", "c_name")
    sinks.write_bulk_file(rows, path, ["c_custkey"])
    pairs = spark.read.text(path, lineSep='{"index"').filter("value != ''")
    lines = F.split("value", "\n")
    return pairs.select(F.concat(F.lit('{"index"'), lines[0]).alias("action"), lines[1].alias("source"))


@query("SELECT '{\"index\":{\"_id\":\"' || n_nationkey || '\"}}' || chr(10) || '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\"}' AS value FROM nation")
def bulk_pairs_of_rows(spark, folder):
    return bulk_pairs(table(spark, folder, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])


@query(f"WITH {TELE_EVENTS} SELECT id, timestamp, kmh FROM tele_events")
def redelivery_dedup(spark, folder):
    rows = tele_events(spark, folder).select("id", "timestamp", "kmh")
    return dedup(rows.unionByName(rows))


@query(
    f"WITH {TELE_EVENTS} SELECT year, month, day, count(*) AS n, sum(kmh) AS kmh FROM tele_events GROUP BY year, month, day"
)
def late_data_rebuild(spark, folder):
    """A daily table built without one event type, then corrected when it arrives late."""

    def daily(df):
        return df.groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.sum("kmh").alias("kmh"))

    path = new_folder(spark, "days")
    rows = tele_events(spark, folder)
    late = F.col("model") == "error"
    sinks.append_partitioned(daily(rows.filter(~late)), path)
    rebuild_days(rows, rows.filter(late), daily, path)
    return files.read_table(spark, path).select("year", "month", "day", "n", "kmh")
