"""Nested JSON built row by row from the tables, and taken apart again."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlog.operators import nested, search
from roadlog.showcase.registry import query, undotted
from roadlog.showcase.views import table


def conversation_docs(spark, folder):
    """``(conv_id, turn, doc)``: one nested JSON document per conversation turn."""
    turns = table(spark, folder, "conversations")
    nothing = F.lit(None).cast("string")
    doc = F.struct(
        F.struct(F.col("conv_id").alias("id"), F.col("turn").alias("turn")).alias("conv"),
        F.array(
            F.struct("role", "text", F.lit(None).cast("int").alias("chars")),
            # to_json leaves the nulls out, so the second entry has other members
            F.struct(nothing.alias("role"), nothing.alias("text"), F.length("text").alias("chars")),
        ).alias("turns"),
        F.array("role", F.lit("x")).alias("tags"),
        F.array().alias("empty"),
    )
    return turns.select("conv_id", "turn", F.to_json(doc).alias("doc"))


def mixed_docs(spark, folder):
    """Documents of several shapes: of every third conversation the turn is a text and
    stands beside a flag that others lack, every fifth has no list."""
    turns = table(spark, folder, "conversations")
    third, fifth = F.col("conv_id") % 3 == 0, F.col("conv_id") % 5 == 0
    plain = F.struct(F.struct("turn").alias("conv"), F.when(~fifth, F.array("role")).alias("tags"))
    other = F.struct(
        F.struct(F.col("turn").cast("string").alias("turn"), (F.length("text") > 50).alias("half")).alias("conv"),
        F.when(~fifth, F.array("role")).alias("tags"),
    )
    return turns.select("conv_id", "turn", F.when(third, F.to_json(other)).otherwise(F.to_json(plain)).alias("doc"))


@query(
    """SELECT path, type, count(*) AS n FROM (
  SELECT 'conv' AS path, 'dict' AS type FROM conversations
  UNION ALL SELECT 'conv.turn', CASE WHEN conv_id % 3 = 0 THEN 'str' ELSE 'int' END FROM conversations
  UNION ALL SELECT 'conv.half', 'bool' FROM conversations WHERE conv_id % 3 = 0
  UNION ALL SELECT 'tags', 'list' FROM conversations WHERE conv_id % 5 <> 0)
GROUP BY path, type"""
)
def schema_profile_mixed(spark, folder):
    return nested.schema_profile(mixed_docs(spark, folder), "doc")


@query(
    """SELECT conv_id, turn, '{"name":"talk","fields":[{"name":"conv","type":"dict","fields":[' ||
  CASE WHEN conv_id % 3 = 0 THEN '{"name":"half","type":"bool"},{"name":"turn","type":"str"}'
    ELSE '{"name":"turn","type":"int"}' END || ']}' ||
  CASE WHEN conv_id % 5 <> 0 THEN ',{"name":"tags","type":"list"}' ELSE '' END || ']}' AS schema FROM conversations"""
)
def extract_schema_mixed(spark, folder):
    return nested.extract_schema(mixed_docs(spark, folder), "doc", "talk").drop("doc")


@query(
    """SELECT CASE WHEN count(*) FILTER (WHERE conv_id % 3 = 0) > 0 AND count(*) FILTER (WHERE conv_id % 3 <> 0) > 0
  AND count(*) FILTER (WHERE conv_id % 5 <> 0) > 0
  THEN 'OBJECT<conv: OBJECT<half: BOOLEAN, turn: VARIANT>, tags: ARRAY<STRING>>' END AS schema FROM conversations"""
)
def merged_schema_mixed(spark, folder):
    return nested.merged_schema(mixed_docs(spark, folder), "doc")


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
def field_caps_mixed(spark, folder):
    docs = mixed_docs(spark, folder)
    third = F.col("conv_id") % 3 == 0
    caps = search.field_caps(
        search.observed_fields(docs.filter(third), "doc", "third"),
        search.observed_fields(docs.filter(~third), "doc", "others"),
    )
    return caps.withColumn("indices", F.array_join("indices", ","))


@query(
    """SELECT event_id, repeat('k.', 39) || 'k' AS path, CAST(user_id AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'k.beside', event_type FROM events"""
)
def json_flatten_deep(spark, folder):
    """Documents of forty levels."""
    rows = table(spark, folder, "events")
    doc = F.concat(F.lit('{"k":{"beside":"'), "event_type", F.lit('",'), F.lit('"k":{' * 38 + '"k":'), "user_id", F.lit("}" * 40))
    flat = nested.flatten_json(rows.select("event_id", doc.alias("doc")), "doc", ["event_id"])
    return flat.withColumn("value", F.expr(nested.variant_text("value")))


# (path, SQL of its text) of every leaf of such a document
_LEAVES = {
    "conv.id": "CAST(conv_id AS VARCHAR)",
    "conv.turn": "CAST(turn AS VARCHAR)",
    "turns.0.role": "role",
    "turns.0.text": "text",
    "turns.1.chars": "CAST(length(text) AS VARCHAR)",
    "tags": """'["' || role || '","x"]'""",
    "empty": "'[]'",
}


@query(
    " UNION ALL ".join(
        f"SELECT conv_id, turn, '{path}' AS path, {value} AS value FROM conversations"
        for path, value in _LEAVES.items()
    )
)
def json_flatten(spark, folder):
    flat = nested.flatten_json(conversation_docs(spark, folder), "doc", ["conv_id", "turn"])
    return flat.withColumn("value", F.expr(nested.variant_text("value")))


@query(
    """SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS conv_id_text, role AS turns_0_role,
  '["' || role || '","x"]' AS tags, CAST(NULL AS VARCHAR) AS no_such FROM conversations"""
)
def json_flatten_wide(spark, folder):
    paths = ["conv.id", "turns.0.role", "tags", "no.such"]
    wide = nested.flatten_wide(conversation_docs(spark, folder), "doc", paths).drop("doc")
    return undotted(wide.withColumnRenamed("conv.id", "conv.id.text"))


@query("""SELECT event_id, user_id AS who_user, event_type AS what_type, value AS what_value FROM events""")
def struct_flatten(spark, folder):
    shaped = table(spark, folder, "events").select(
        "event_id",
        F.struct(F.col("user_id").alias("user")).alias("who"),
        F.struct(F.col("event_type").alias("type"), "value").alias("what"),
    )
    return undotted(nested.flatten_struct(shaped))


def mixed_texts(spark, folder):
    """``(event_id, text)``: JSON, Python literals and broken text, by event type."""
    events = table(spark, folder, "events")
    literal = F.concat(F.lit("{'k': "), F.get_json_object("props", "$.k"), F.lit(", 'seen': True, 'by': None}"))
    broken = F.substring("props", 1, 4)
    return events.select(
        "event_id",
        F.when(F.col("event_type").isin("view", "click"), literal)
        .when(F.col("event_type") == "error", broken)
        .otherwise(F.col("props"))
        .alias("text"),
    )


@query(
    """SELECT event_id,
  CASE WHEN event_type IN ('view', 'click') THEN 'literal' WHEN event_type = 'error' THEN 'failed' ELSE 'json' END
    AS decode_path,
  CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_type IN ('view', 'click') THEN true END AS seen
FROM events"""
)
def json_tolerant_decode(spark, folder):
    decoded = nested.decode_tolerant(mixed_texts(spark, folder), "text")
    return decoded.select(
        "event_id",
        "decode_path",
        F.try_variant_get("doc", "$.k", "long").alias("k"),
        F.try_variant_get("doc", "$.seen", "boolean").alias("seen"),
    )


@query(
    """SELECT * FROM (SELECT count(*) AS n FROM conversations) c, (VALUES
  ('conv', 'dict'), ('conv.id', 'int'), ('conv.turn', 'int'), ('turns', 'list'), ('tags', 'list'), ('empty', 'list')
) AS p(path, type)"""
)
def schema_profile(spark, folder):
    return nested.schema_profile(conversation_docs(spark, folder), "doc")


@query(
    """SELECT conv_id, turn, '{"name":"talk","fields":[{"name":"conv","type":"dict","fields":[' ||
  '{"name":"id","type":"int"},{"name":"turn","type":"int"}]},{"name":"empty","type":"list"},' ||
  '{"name":"tags","type":"list"},{"name":"turns","type":"list"}]}' AS schema FROM conversations"""
)
def extract_schema(spark, folder):
    return nested.extract_schema(conversation_docs(spark, folder), "doc", "talk").drop("doc")


@query(
    "SELECT CASE WHEN count(*) > 0 THEN 'OBJECT<k: BIGINT>' END AS schema FROM events WHERE props IS NOT NULL"
)
def merged_schema(spark, folder):
    return nested.merged_schema(table(spark, folder, "events"), "props")


@query(
    """SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type ||
  '","value":' || value || ',"price":' || CAST(CAST(value AS DECIMAL(12, 2)) AS DOUBLE) ||
  ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","day":"' || strftime(ts, '%Y-%m-%d') || '"}' AS value
FROM events"""
)
def rows_to_json(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("value").cast("decimal(12,2)").alias("price"),
        "ts",
        F.col("ts").cast("date").alias("day"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return rows.select("event_id", nested.row_json(rows).alias("value"))


@query(
    """SELECT field, type, string_agg(idx, ',' ORDER BY idx) AS indices FROM (
  SELECT DISTINCT 'talks' AS idx, field, type FROM (SELECT count(*) AS n FROM conversations) c, (VALUES
    ('conv', 'dict'), ('conv.id', 'int'), ('conv.turn', 'int'), ('turns', 'list'), ('tags', 'list'), ('empty', 'list')
  ) AS p(field, type) WHERE n > 0
  UNION ALL SELECT DISTINCT 'props', 'k', 'int' FROM events WHERE json_extract(props, '$.k') IS NOT NULL
  UNION ALL SELECT DISTINCT 'texts', 'k', 'int' FROM events WHERE event_type IN ('purchase', 'signup')
) GROUP BY field, type"""
)
def field_caps(spark, folder):
    caps = search.field_caps(
        search.observed_fields(conversation_docs(spark, folder), "doc", "talks"),
        search.observed_fields(table(spark, folder, "events"), "props", "props"),
        search.observed_fields(mixed_texts(spark, folder), "text", "texts"),
    )
    return caps.withColumn("indices", F.array_join("indices", ","))
