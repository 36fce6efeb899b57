"""Writes in one order: versions of documents, and chunks of a whole stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadlog.operators import bulk, documents, versioned
from roadlog.operators.ordered import positions
from roadlog.showcase.documents import _OP_SQL, _priority_op, customer_docs, event_actions
from roadlog.showcase.registry import query
from roadlog.showcase.views import table


def _customers(spark, folder):
    """The customer documents, each last written with the number of its key."""
    key = F.col("_id").cast("long")
    return customer_docs(spark, folder).withColumns(
        {"_version": F.lit(1).cast("long"), "_seq_no": key, "_primary_term": 1 + key % 2}
    )


def _order_writes(spark, folder):
    """``seq, place, before, op, _id, source`` of the orders; ``before`` is the place of the customer's last order."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    placed = positions(orders, ["o_orderkey"], "place")
    op = F.coalesce(_priority_op(), F.lit("index"))
    total = F.struct(F.col("o_totalprice").alias("total"))
    source = F.when(op == "update", F.to_json(F.struct(total.alias("doc")))).otherwise(F.to_json(total))
    return placed.select(
        F.col("o_orderkey").alias("seq"),
        "place",
        F.lag("place").over(Window.partitionBy("o_custkey").orderBy("place")).alias("before"),
        op.alias("op"),
        F.col("o_custkey").cast("string").alias("_id"),
        F.when(op != "delete", source).alias("source"),
        F.floor("o_totalprice").alias("price"),
    )


# One action of every customer a step.  The state is (present, version, seq_no, term).
_STEPS = """nums AS (
  SELECT o_orderkey AS seq, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, {op} AS op, o_custkey AS cust,
    CAST(floor(o_totalprice) AS BIGINT) AS price, o_totalprice AS total FROM orders),
writes AS (
  SELECT *, lag(place) OVER (PARTITION BY cust ORDER BY place) AS before,
    row_number() OVER (PARTITION BY cust ORDER BY place) AS k FROM nums),
asked AS (SELECT *, {conditions} FROM writes, (SELECT max(c_custkey) + 1 AS first FROM customer)),
steps AS (
  SELECT n.cust, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS op, CAST(NULL AS INTEGER) AS status,
    c_custkey IS NOT NULL AS present, CAST(CASE WHEN c_custkey IS NULL THEN -1 ELSE 1 END AS BIGINT) AS version,
    CAST(coalesce(c_custkey, -1) AS BIGINT) AS seq_no, CAST(coalesce(1 + c_custkey % 2, -1) AS BIGINT) AS term,
    CAST(NULL AS DOUBLE) AS total
  FROM (SELECT o_custkey AS cust FROM orders UNION SELECT c_custkey FROM customer) n LEFT JOIN customer ON c_custkey = n.cust
  UNION ALL
  SELECT cust, k, seq, op, status, CASE WHEN passes THEN op <> 'delete' ELSE present END,
    CASE WHEN NOT passes THEN version WHEN given IS NOT NULL THEN given ELSE greatest(version, 0) + 1 END,
    CASE WHEN passes THEN first + place ELSE seq_no END, CASE WHEN passes THEN 1 ELSE term END,
    CASE WHEN passes AND op <> 'delete' THEN new_total ELSE total END
  FROM (
    SELECT *, status < 300 OR (given IS NOT NULL AND status = 404) AS passes
    FROM (
      SELECT a.cust, a.k, a.seq, a.op, a.place, a.given, a.first, a.total AS new_total, s.present, s.version, s.seq_no, s.term,
        s.total,
        CASE WHEN a.expects IS NOT NULL AND NOT (s.present AND s.seq_no = a.expects AND s.term = a.of_term) THEN 409
          WHEN a.given IS NOT NULL AND NOT (a.given > s.version OR (a.equal_passes AND a.given = s.version)) THEN 409
          WHEN a.op = 'create' AND s.present THEN 409
          WHEN a.op IN ('update', 'delete') AND NOT s.present THEN 404
          WHEN s.present THEN 200 ELSE 201 END AS status
      FROM steps s JOIN asked a ON a.cust = s.cust AND a.k = s.k + 1)))"""


def _steps(conditions: str) -> str:
    return "WITH RECURSIVE " + _STEPS.format(op=_OP_SQL, conditions=conditions)


@query(
    _steps(
        """CASE WHEN op = 'create' THEN NULL WHEN seq % 4 = 0 THEN cust WHEN seq % 4 = 1 THEN first + before END AS expects,
      CASE WHEN seq % 4 = 0 THEN 1 + cust % 2 ELSE 1 END AS of_term, CAST(NULL AS BIGINT) AS given, false AS equal_passes"""
    )
    + """
SELECT seq, op, CAST(cust AS VARCHAR) AS _id, status, status < 300 AS ok, greatest(version, 0) AS _version, seq_no AS _seq_no
FROM steps WHERE k > 0"""
)
def apply_versioned(spark, folder):
    """Orders written to their customers, half of them if nothing else was written since."""
    customers = _customers(spark, folder)
    first = table(spark, folder, "customer").agg(F.max("c_custkey") + 1).first()[0]
    seq = F.col("seq")
    expects = F.when(seq % 4 == 0, F.col("_id").cast("long")).when(seq % 4 == 1, first + F.col("before"))
    term = F.when(seq % 4 == 0, 1 + F.col("_id").cast("long") % 2).otherwise(1)
    writes = _order_writes(spark, folder)
    expects = F.when(F.col("op") != "create", expects)
    given = writes.select(
        "seq",
        F.col("op").alias("_op_type"),
        "_id",
        expects.alias("if_seq_no"),
        F.when(expects.isNotNull(), term).alias("if_primary_term"),
        F.col("source").alias("_source"),
    )
    # through the lines that a sender would write
    actions = versioned.with_conditions(documents.expand_actions(given))
    return versioned.apply_versioned(customers, actions).results.drop("_index", "source", "error")


@query(
    _steps(
        """CAST(NULL AS BIGINT) AS expects, 1 AS of_term, seq % 2 = 1 AS equal_passes,
      CASE WHEN op IN ('index', 'delete') AND seq % 5 <> 0 THEN price % 50 END AS given"""
    )
    + """
SELECT CAST(cust AS VARCHAR) AS _id, last.version AS _version, last.seq_no AS _seq_no, last.term AS _primary_term, last.total AS total
FROM (SELECT cust, max_by(struct_pack(present := present, version := version, seq_no := seq_no, term := term, total := total), k) AS last
  FROM steps GROUP BY cust)
WHERE last.present"""
)
def apply_external_versions(spark, folder):
    """Versions that the orders bring, among writes that count them up."""
    seq = F.col("seq")
    own = F.col("op").isin("index", "delete") & (seq % 5 != 0)
    actions = _order_writes(spark, folder).select(
        "seq",
        "op",
        "_id",
        "source",
        F.when(own, F.col("price") % 50).alias("version"),
        F.when(own, F.when(seq % 2 == 1, "external_gte").otherwise("external")).alias("version_type"),
    )
    total = F.try_variant_get(F.parse_json("source"), "$.total", "double").alias("total")
    return versioned.apply_versioned(_customers(spark, folder), actions).table.select(
        "_id", "_version", "_seq_no", "_primary_term", total
    )


# the next chunk starts at the first action that would be the 101st or take the bytes over the limit
@query(
    """WITH RECURSIVE sized AS (
  SELECT event_id, n, row_number() OVER w AS place, sum(n) OVER w AS ends
  FROM (SELECT event_id, length('{"index":{"_id":"' || event_id || '"}}') + 1 +
      length('{"event_type":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '"}') + 1 AS n FROM events)
  WINDOW w AS (ORDER BY event_id)),
cuts AS (
  SELECT CAST(0 AS BIGINT) AS chunk, CAST(1 AS BIGINT) AS place, CAST(0 AS BIGINT) AS used FROM (SELECT 1 FROM sized LIMIT 1)
  UNION ALL
  SELECT chunk + 1, place, used FROM (
    SELECT c.chunk, min(s.place) AS place, CAST(min(s.ends - s.n) AS BIGINT) AS used
    FROM cuts c JOIN sized s ON s.place > c.place AND (s.ends - c.used > 12000 OR s.place - c.place >= 100)
    GROUP BY c.chunk)),
bounds AS (SELECT *, lead(place) OVER (ORDER BY chunk) AS next FROM cuts)
SELECT chunk, count(*) AS n, CAST(sum(n) AS BIGINT) AS bytes, min(event_id) AS first_seq, max(event_id) AS last_seq
FROM bounds b JOIN sized s ON s.place >= b.place AND (b.next IS NULL OR s.place < b.next)
GROUP BY chunk"""
)
def bulk_stream_chunks(spark, folder):
    """All events in one order, cut greedily by count and bytes."""
    chunks = bulk.chunk_stream(event_actions(spark, folder), 100, 12000, block_bits=10)
    return chunks.groupBy("chunk").agg(
        F.count("*").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )
