"""Connected components of a graph that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlog.workspace import written


def _towards_least_of_all(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _towards_least_below(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    others = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)`` (longs, any direction).

    A component is named by its least node.  The two steps alternate until
    nothing changes; what is compared between rounds is a row count and a checksum.
    The least neighbours are found with a map-side part, and written, so that the
    join with the edges is a plain one whose large keys Spark can split.  The state
    of each round is a table in the shared folder.  Loops and repeated edges are
    ignored.
    """
    current = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")
        ).first()
        if (mark.n, mark["sum"]) == seen or not mark.n:
            break
        seen = (mark.n, mark["sum"])
        current = written(_towards_least_below(_towards_least_of_all(current)), "edges")
    hung = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = current.select(F.col("b").alias("node")).distinct()
    return hung.unionByName(roots.select("node", F.col("node").alias("component")))
