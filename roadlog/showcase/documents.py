"""Documents, bulk actions, keyed tables and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlog.operators import bulk, documents, keyed, search
from roadlog.operators.ordered import last_before
from roadlog.schemas import VEHICLE_DAY
from roadlog.showcase.registry import query
from roadlog.showcase.views import LINE_KEYS, TELE_LINE, table, tele_line

_LINE_ID = "id || '|' || year || '|' || month"


@query(
    f"""WITH {TELE_LINE}
SELECT {_LINE_ID} AS _id, '{{"breakActive":' || breakActive || '}}' AS source, count(*) AS n
FROM tele_line GROUP BY ALL"""
)
def document_ids(spark, folder):
    rows = tele_line(spark, folder).select(*LINE_KEYS, "breakActive")
    docs = documents.document_ids(rows, LINE_KEYS, remove_keys=True)
    return docs.groupBy("_id", "source").agg(F.count("*").alias("n"))


@query(
    f"""WITH {TELE_LINE}
SELECT id || '' || year || month || day AS _id, count(*) AS n_keys
FROM (SELECT DISTINCT id, year, month, day FROM tele_line) GROUP BY 1 HAVING count(*) > 1"""
)
def document_id_collisions(spark, folder):
    return documents.document_id_collisions(tele_line(spark, folder), VEHICLE_DAY, sep="")


@query(
    """SELECT event_id, 0 AS pos, '{"index":{"_id":"' || event_id || '"}}' AS line FROM events
UNION ALL SELECT event_id, 1, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' FROM events"""
)
def bulk_lines(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "event_type")
    return documents.bulk_lines(rows, ["event_id"], ["event_id"])


@query(
    """SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 500 AS chunk FROM events"""
)
def bulk_chunks(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    return bulk.chunk_by_count(events, "event_id", 500)


def event_actions(spark, folder):
    """Index actions of all events, as sent."""
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("_id"), "event_type", "props"
    )
    return documents.expand_actions(rows)


# lanes of 4096 actions and chunks of 500: the byte limit is not reached
@query(
    """SELECT event_id AS seq, event_id // 4096 AS lane,
  (row_number() OVER (PARTITION BY event_id // 4096 ORDER BY event_id) - 1) // 500 AS chunk FROM events"""
)
def bulk_lane_chunks(spark, folder):
    chunks = bulk.chunk_actions(event_actions(spark, folder), lane_bits=12)
    return chunks.select("seq", "lane", "chunk")


# greedy cuts, one chunk per step: the next chunk starts at the first action that
# would be the 501st or take the bytes over the limit
@query(
    """WITH RECURSIVE sized AS (
  SELECT lane, n, row_number() OVER w AS place, sum(n) OVER w AS ends
  FROM (SELECT event_id, event_id // 4096 AS lane,
      length('{"index":{"_id":"' || event_id || '"}}') + 1 +
      length('{"event_type":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '"}') + 1 AS n FROM events)
  WINDOW w AS (PARTITION BY lane ORDER BY event_id)),
cuts AS (
  SELECT lane, 0 AS chunk, CAST(1 AS BIGINT) AS place, CAST(0 AS BIGINT) AS used FROM sized GROUP BY lane
  UNION ALL
  SELECT c.lane, c.chunk + 1, min(s.place), CAST(min(s.ends - s.n) AS BIGINT)
  FROM cuts c JOIN sized s ON s.lane = c.lane AND s.place > c.place
    AND (s.ends - c.used > 8192 OR s.place - c.place >= 500)
  GROUP BY c.lane, c.chunk),
bounds AS (SELECT *, lead(place) OVER (PARTITION BY lane ORDER BY chunk) AS next FROM cuts)
SELECT b.lane, CAST(b.chunk AS BIGINT) AS chunk, count(*) AS n, CAST(sum(s.n) AS BIGINT) AS bytes
FROM bounds b JOIN sized s ON s.lane = b.lane AND s.place >= b.place AND (b.next IS NULL OR s.place < b.next)
GROUP BY b.lane, b.chunk"""
)
def bulk_byte_chunks(spark, folder):
    """Chunks cut by their size in bytes."""
    chunks = bulk.chunk_actions(event_actions(spark, folder), max_bytes=8192, lane_bits=12)
    return chunks.groupBy("lane", "chunk").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


# --- actions ------------------------------------------------------------------

# Fixed values of the showcase: the operation of an order by its priority.
_OP = {"1-URGENT": "create", "2-HIGH": "update", "3-MEDIUM": "delete", "5-LOW": "index"}
_OP_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN '{op}'" for p, op in _OP.items()) + " ELSE 'index' END"


def _priority_op():
    op = F.lit(None).cast("string")
    for priority, name in _OP.items():
        op = F.when(F.col("o_orderpriority") == priority, name).otherwise(op)
    return op


def order_actions(spark, folder):
    """``(seq, op, _id, source)``: an action on the customer's document per order."""
    full = F.to_json(
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.struct(F.col("o_orderkey").alias("key")).alias("last"),
        )
    )
    part = F.to_json(
        F.struct(
            F.struct(
                F.col("o_totalprice").alias("total"),
                F.struct(F.col("o_orderpriority").alias("priority")).alias("last"),
            ).alias("doc")
        )
    )
    op = _priority_op()
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"),
        op.alias("op"),
        F.col("o_custkey").cast("string").alias("_id"),
        F.when(op == "update", part).when(F.coalesce(op, F.lit("index")) != "delete", full).alias("source"),
    )


def customer_docs(spark, folder):
    """Document table ``(_id, source)`` of the customers."""
    return documents.document_ids(
        table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"], remove_keys=True
    )


# The same in SQL: presence before an action is that of the last action that is
# no update; the customer rows come before all actions.
_EVENTS_SQL = f"""ev AS (
  SELECT -1 AS seq, 'index' AS op, CAST(c_custkey AS VARCHAR) AS _id, c_name AS name, NULL AS status,
    NULL::DOUBLE AS total, NULL::BIGINT AS last_key, NULL AS last_priority FROM customer
  UNION ALL SELECT o_orderkey, {_OP_SQL}, CAST(o_custkey AS VARCHAR), NULL, o_orderstatus, o_totalprice, o_orderkey,
    o_orderpriority FROM orders),
scored AS (
  SELECT *, coalesce(last_value(CASE WHEN op IN ('index', 'create') THEN 1 WHEN op = 'delete' THEN 0 END IGNORE NULLS)
    OVER (PARTITION BY _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS present FROM ev),
res AS (
  SELECT *, CASE op WHEN 'index' THEN CASE present WHEN 1 THEN 200 ELSE 201 END
    WHEN 'create' THEN CASE present WHEN 1 THEN 409 ELSE 201 END
    ELSE CASE present WHEN 1 THEN 200 ELSE 404 END END AS status_code FROM scored)"""

_APPLIED_SQL = f"""WITH {_EVENTS_SQL},
base AS (SELECT _id, max(seq) AS seq, max_by(op, seq) AS op FROM res
  WHERE status_code < 300 AND op <> 'update' GROUP BY _id),
live AS (SELECT r.*, b.seq AS base_seq FROM res r JOIN base b USING (_id)
  WHERE b.op <> 'delete' AND r.status_code < 300 AND r.seq >= b.seq AND (r.seq = b.seq OR r.op = 'update'))
SELECT _id, max(name) FILTER (WHERE seq = base_seq) AS name, max(status) FILTER (WHERE seq = base_seq) AS status,
  max_by(total, seq) AS total, max(last_key) FILTER (WHERE seq = base_seq) AS last_key,
  max_by(last_priority, seq) FILTER (WHERE op = 'update') AS last_priority
FROM live GROUP BY _id"""


def _applied(spark, folder):
    return keyed.apply_actions(customer_docs(spark, folder), order_actions(spark, folder))


@query(_APPLIED_SQL)
def apply_actions(spark, folder):
    doc = F.parse_json("source")
    return _applied(spark, folder).table.select(
        "_id",
        F.try_variant_get(doc, "$.c_name", "string").alias("name"),
        F.try_variant_get(doc, "$.status", "string").alias("status"),
        F.try_variant_get(doc, "$.total", "double").alias("total"),
        F.try_variant_get(doc, "$.last.key", "long").alias("last_key"),
        F.try_variant_get(doc, "$.last.priority", "string").alias("last_priority"),
    )


@query(
    f"""WITH {_EVENTS_SQL}
SELECT seq, op, _id, status_code AS status, status_code < 300 AS ok,
  CASE status_code WHEN 404 THEN 'document_missing_exception' WHEN 409 THEN 'version_conflict_engine_exception' END
    AS error FROM res WHERE seq >= 0"""
)
def apply_results(spark, folder):
    return _applied(spark, folder).results.drop("source")


@query(
    f"""WITH {_EVENTS_SQL}
SELECT op, count(*) FILTER (WHERE status_code < 300) AS success, count(*) FILTER (WHERE status_code >= 300) AS failed
FROM res WHERE seq >= 0 GROUP BY op"""
)
def outcome_tally(spark, folder):
    return keyed.outcome_tally(_applied(spark, folder).results)


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS _id, max_by(o_totalprice, o_orderkey) AS total FROM orders
GROUP BY o_custkey HAVING max_by(o_orderstatus, o_orderkey) <> 'P'
UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def last_write_wins(spark, folder):
    actions = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "delete").otherwise("index").alias("op"),
        F.col("o_custkey").cast("string").alias("_id"),
        F.to_json(F.struct(F.col("o_totalprice").alias("total"))).alias("source"),
    )
    final = keyed.last_write_wins(customer_docs(spark, folder), actions)
    return final.select("_id", F.get_json_object("source", "$.total").cast("double").alias("total"))


def awkward_actions(spark, folder):
    """The order actions with what a sender can get wrong: no id, no source, a source
    that is no object, an unknown operation; orders of one status go to an index of their own."""
    key, op = F.col("o_orderkey"), _priority_op()
    op = F.when(key % 13 == 0, "explode").otherwise(F.coalesce(op, F.lit("index")))
    total = F.struct(F.col("o_totalprice").alias("total"))
    good = F.when(op == "update", F.to_json(F.struct(total.alias("doc")))).otherwise(F.to_json(total))
    return table(spark, folder, "orders").select(
        key.alias("seq"),
        op.alias("op"),
        F.when(F.col("o_orderstatus") == "O", "open").alias("_index"),
        F.when(key % 11 != 0, F.col("o_custkey").cast("string")).alias("_id"),
        F.when(key % 7 == 0, None).when(key % 7 == 1, "[1]").when(key % 7 == 2, "{oops").otherwise(good).alias("source"),
    )


def _awkward(spark, folder):
    return keyed.apply_actions(
        customer_docs(spark, folder), awkward_actions(spark, folder), id_prefix="own"
    )


_AWKWARD_SQL = f"""acts AS (
  SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 13 = 0 THEN 'explode' ELSE {_OP_SQL} END AS op,
    CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE '' END AS _index, o_orderkey % 11 <> 0 AS named,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR)
      ELSE 'own-' || (row_number() OVER (ORDER BY o_orderkey) - 1) END AS _id,
    o_orderkey % 7 > 2 AS sound, o_totalprice AS total FROM orders),
ev AS (
  SELECT *, CASE WHEN op IN ('index', 'create') THEN sound WHEN op = 'update' THEN sound AND named
    WHEN op = 'delete' THEN named ELSE false END AS usable FROM acts
  UNION ALL SELECT -1, 'index', '', true, CAST(c_custkey AS VARCHAR), true, NULL, true FROM customer),
scored AS (
  SELECT *, coalesce(last_value(CASE WHEN NOT usable THEN NULL WHEN op IN ('index', 'create') THEN 1
      WHEN op = 'delete' THEN 0 END IGNORE NULLS)
    OVER (PARTITION BY _index, _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS present FROM ev),
res AS (
  SELECT *, CASE WHEN NOT usable THEN 400 WHEN op IN ('index', 'create') AND present = 0 THEN 201
    WHEN op = 'create' THEN 409 WHEN present = 1 THEN 200 ELSE 404 END AS status FROM scored)"""


@query(
    f"""WITH {_AWKWARD_SQL}
SELECT seq, op, _index, _id, status, status < 300 AS ok FROM res WHERE seq >= 0"""
)
def apply_awkward(spark, folder):
    """One result for every action, however it is written."""
    return _awkward(spark, folder).results.drop("source", "error")


@query(
    f"""WITH {_AWKWARD_SQL},
base AS (SELECT _index, _id, max(seq) AS seq, max_by(op, seq) AS op FROM res
  WHERE status < 300 AND op <> 'update' GROUP BY _index, _id)
SELECT _index, _id, max_by(total, r.seq) FILTER (WHERE total IS NOT NULL) AS total
FROM res r JOIN base b USING (_index, _id)
WHERE b.op <> 'delete' AND r.status < 300 AND (r.seq = b.seq OR r.op = 'update' AND r.seq > b.seq)
GROUP BY _index, _id"""
)
def apply_awkward_documents(spark, folder):
    """The documents after them, of two indices that share ids."""
    total = F.try_variant_get(F.parse_json("source"), "$.total", "double")
    return _awkward(spark, folder).table.select("_index", "_id", total.alias("total"))


@query(
    f"""SELECT o_orderkey AS seq, op, 'orders' AS _index, CAST(o_custkey AS VARCHAR) AS _id,
  '{{"' || op || '":{{"_id":"' || o_custkey || '","_index":"orders","routing":"' || o_orderstatus || '"}}}}' AS action_line,
  CASE WHEN op <> 'delete' THEN '{{"total":' || o_totalprice || '}}' END AS source_line
FROM (SELECT *, {_OP_SQL} AS op FROM orders)"""
)
def expand_actions(spark, folder):
    return documents.expand_actions(
        table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("seq"),
            _priority_op().alias("_op_type"),
            F.lit("orders").alias("_index"),
            F.col("o_custkey").cast("string").alias("_id"),
            F.col("o_orderstatus").alias("_routing"),
            F.col("o_totalprice").alias("total"),
        )
    )


@query(
    f"""SELECT o_orderkey AS seq, op, CAST(NULL AS VARCHAR) AS _index, CAST(o_custkey AS VARCHAR) AS _id,
  '{{"' || op || '":{{"_id":' || o_custkey || ',"version":' || o_orderkey || '}}}}' AS action_line,
  CASE WHEN op <> 'delete' THEN '{{"status":"' || o_orderstatus || '"}}' END AS source_line
FROM (SELECT *, {_OP_SQL} AS op FROM orders)"""
)
def expand_json_actions(spark, folder):
    text = F.to_json(
        F.struct(
            _priority_op().alias("_op_type"),
            F.col("o_custkey").alias("_id"),
            F.col("o_orderkey").alias("_version"),
            F.struct(F.col("o_orderstatus").alias("status")).alias("_source"),
            F.col("o_totalprice").alias("ignored"),
        )
    )
    actions = table(spark, folder, "orders").select(F.col("o_orderkey").alias("seq"), text.alias("action"))
    return documents.expand_json_actions(actions, "action")


@query("""SELECT event_id AS seq, '{"index":{}}' AS action_line, props AS source_line FROM events""")
def expand_raw(spark, folder):
    rows = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "props")
    return documents.expand_raw(rows, "props").select("seq", "action_line", "source_line")


@query(
    """SELECT event_id // 4096 AS lane, (place - 1) // 500 AS chunk, count(*) AS n,
  CAST(sum(length(line) + 1) AS BIGINT) AS bytes, string_agg(line || chr(10), '' ORDER BY event_id) AS payload
FROM (SELECT event_id, row_number() OVER (PARTITION BY event_id // 4096 ORDER BY event_id) AS place,
    '{"index":{"_id":"' || event_id || '"}}' || chr(10) || '{"event_type":"' || event_type || '","props":"' ||
    replace(props, '"', '\\"') || '"}' AS line FROM events)
GROUP BY 1, 2"""
)
def bulk_payloads(spark, folder):
    """Request bodies, ready to be sent by a partition's task."""
    return bulk.chunk_payloads(event_actions(spark, folder), lane_bits=12)


@query(
    """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_error FROM events"""
)
def last_before_in_order(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    value = F.when(F.col("event_type") == "error", F.col("value"))
    return last_before(events, ["user_id"], "event_id", value, "last_error", block_bits=8).drop("event_type", "value")


# --- maintenance --------------------------------------------------------------


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice AS total, 'big' AS _index, o_orderpriority AS priority
FROM orders WHERE o_totalprice > 250000"""
)
def reindex_filtered(spark, folder):
    src = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.lit("orders").alias("_index"),
        F.col("o_totalprice").alias("total"),
        F.struct(F.col("o_orderpriority").alias("priority")).alias("fields"),
    )
    return keyed.reindex_documents(src, F.col("total") > 250000, "big")


@query(
    """SELECT coalesce(o._id, c._id) AS _id, CASE WHEN o._id IS NULL THEN c.seg END AS segment, o.total
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice AS total FROM orders WHERE o_orderstatus = 'F') o
FULL JOIN (SELECT CAST(c_custkey AS VARCHAR) AS _id, c_mktsegment AS seg FROM customer) c USING (_id)"""
)
def reindex_into(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    src = documents.document_ids(orders, ["o_orderkey"], remove_keys=True)
    only = F.get_json_object("source", "$.o_orderstatus") == "F"
    moved = keyed.reindex(src, customer_docs(spark, folder), only, "customers").table
    return moved.select(
        "_id",
        F.get_json_object("source", "$.c_mktsegment").alias("segment"),
        F.get_json_object("source", "$.o_totalprice").cast("double").alias("total"),
    )


@query(
    """SELECT 'big' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, o_orderpriority AS priority, o_totalprice AS total
FROM orders WHERE o_totalprice > 250000
UNION ALL SELECT i, CAST(c_custkey AS VARCHAR), 'kept', NULL FROM customer, (VALUES ('big'), ('old')) AS x(i)
WHERE NOT (i = 'big' AND c_custkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 250000))"""
)
def reindex_lifted(spark, folder):
    """Copies with their lifted fields, over documents of the same ids in two indices."""
    src = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.lit("orders").alias("_index"),
        F.to_json(F.struct(F.col("o_totalprice").alias("total"))).alias("source"),
        F.struct(F.col("o_orderpriority").alias("priority")).alias("fields"),
    )
    docs = customer_docs(spark, folder).withColumn("priority", F.lit("kept"))
    target = docs.withColumn("_index", F.explode(F.array(F.lit("big"), F.lit("old"))))
    total = F.get_json_object("source", "$.total").cast("double")
    moved = keyed.reindex(src, target, total > 250000, "big").table
    return moved.select("_index", "_id", "priority", total.alias("total"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 300000)")
def delete_by_query(spark, folder):
    rows = table(spark, folder, "orders")
    kept = keyed.delete_where(rows, "o_orderstatus = 'F' AND o_totalprice < 300000")
    return kept.select("o_orderkey", "o_totalprice")


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN
  (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice, o_orderkey LIMIT 1000)"""
)
def delete_by_query_capped(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return keyed.delete_where(
        rows, "o_orderstatus = 'F'", 1000, ("o_totalprice", "o_orderkey"), ("o_orderkey",)
    ).select("o_orderkey")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders"""
)
def update_by_query(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return keyed.update_where(
        rows, "o_orderstatus = 'P'", {"o_totalprice": "o_totalprice * 2", "o_orderstatus": F.lit("F")}
    )


@query("SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'P') AS matched FROM orders")
def match_tally(spark, folder):
    return keyed.match_tally(table(spark, folder, "orders"), "o_orderstatus = 'P'")


# --- lookups ------------------------------------------------------------------


def _order_docs(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderkey").alias("_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )


# there are more parts than customers, so some ids are not found
@query(
    """SELECT l_partkey AS _id, c_acctbal AS balance, c_custkey IS NOT NULL AS found
FROM lineitem LEFT JOIN customer ON l_partkey = c_custkey"""
)
def lookup_ids(spark, folder):
    wanted = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("_id"))
    docs = table(spark, folder, "customer").select(F.col("c_custkey").alias("_id"), F.col("c_acctbal").alias("balance"))
    return search.lookup(docs, wanted)


@query(
    """SELECT CAST(i._id AS BIGINT) AS _id, o.o_totalprice AS total, o.o_orderkey IS NOT NULL AS found
FROM (VALUES (7), (3), (7), (-1)) AS i(_id) LEFT JOIN orders o ON o.o_orderkey = i._id"""
)
def lookup_id_list(spark, folder):
    docs = _order_docs(spark, folder).select("_id", "total")
    return search.lookup(docs, [7, 3, 7, -1])


@query("SELECT c_custkey AS _id, c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer")
def exists_ids(spark, folder):
    docs = table(spark, folder, "orders").select(F.col("o_custkey").alias("_id"))
    return search.exists_ids(docs, table(spark, folder, "customer").select(F.col("c_custkey").alias("_id")))


@query("SELECT c_custkey AS _id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def existing_ids(spark, folder):
    docs = table(spark, folder, "orders").select(F.col("o_custkey").alias("_id"))
    return search.existing_ids(docs, table(spark, folder, "customer").select(F.col("c_custkey").alias("_id")))


@query("SELECT p_partkey AS _id FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)")
def missing_ids(spark, folder):
    docs = table(spark, folder, "customer").select(F.col("c_custkey").alias("_id"))
    return search.missing_ids(docs, table(spark, folder, "part").select(F.col("p_partkey").alias("_id")))


@query(
    """SELECT o_orderkey AS _id, o_totalprice AS total FROM orders WHERE o_orderpriority = '1-URGENT'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50"""
)
def search_page(spark, folder):
    return search.search_page(
        _order_docs(spark, folder), "priority = '1-URGENT'", ["total:desc", "_id"], 50, 25, exclude=["customer", "priority"]
    )


@query("SELECT count(*) AS count FROM orders WHERE o_totalprice > 400000")
def match_count(spark, folder):
    return search.match_count(_order_docs(spark, folder), "total > 400000")


@query(
    """SELECT 'dear' AS search, * FROM (SELECT o_orderkey AS _id, o_totalprice AS total, NULL AS priority
  FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL SELECT 'first low', * FROM (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
  WHERE o_orderpriority = '5-LOW' ORDER BY o_orderkey LIMIT 5 OFFSET 5)"""
)
def multi_search(spark, folder):
    return search.multi_search(
        _order_docs(spark, folder),
        {
            "dear": search.Search(sort=["total:desc", "_id"], columns=["_id", "total"]),
            "first low": search.Search("priority = '5-LOW'", ["_id"], 5, 5, ["_id", "total", "priority"]),
        },
    )


@query("SELECT o_orderkey AS _id, o_totalprice AS total FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice, o_orderkey")
def scan_ordered(spark, folder):
    docs = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("total"), "o_orderstatus"
    )
    return search.scan_documents(docs, "o_orderstatus = 'O'", True, ["total", "_id"]).drop("o_orderstatus")
