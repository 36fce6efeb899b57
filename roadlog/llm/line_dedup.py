"""Lines that several documents share stay in one of them.

Lines are exploded under the hash of their normal form; documents are counted for
each hash, with a map-side part; what is counted too often is dropped from all
documents but the first that holds it, and the texts are put together again by
position.  Only hashes and positions are shuffled until then: a very common line
shrinks to one row a task before it is counted, and the join that finds its places
is a plain one whose large keys Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.llm.common import let, texts
from roadlog.workspace import written

# white space at the ends of a line
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# columns that hold 128 bits: of a line's normal form, and of a row
_LINE, _ROW = ("_line1", "_line2"), ("_row1", "_row2")


def normal_line(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashes(names: tuple[str, str], *values: Column) -> list[Column]:
    """128 bits of the values, as two longs."""
    return [F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in enumerate(names)]


def _split(text: str) -> Column:
    return F.split(text, "\n", -1)


def shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The normal forms found in ``min_docs`` rows, as hashes, with the document that
    keeps them: ``_line1, _line2, _holder`` (its ``doc_id``; null if no holder has one,
    then ``_unnamed`` is the first hash of the row)."""
    keys = F.filter(F.transform(_split("text"), normal_line), lambda x: F.length(x) >= min_chars)
    # a row counts once for a line, however often it has it
    lines = docs.select("doc_id", _ROW[0], F.explode(F.array_distinct(keys)).alias("key"))
    return (
        lines.select("doc_id", _ROW[0], *_hashes(_LINE, F.col("key")))
        .groupBy(*_LINE)
        .agg(
            F.count("*").alias("_n"),
            F.min("doc_id").alias("_holder"),
            F.min(F.when(F.col("doc_id").isNull(), F.col(_ROW[0]))).alias("_unnamed"),
        )
        .filter(F.col("_n") >= min_docs)
        .drop("_n")
    )


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every row of ``docs``, without lines that
    ``min_docs`` rows or more have in common.

    Lines are what line feeds separate; a null or empty text is one empty line.  Two
    lines are the same when they are equal without blanks at both ends and with A-Z
    in lower case; normal forms of under ``min_chars`` code points are never dropped.
    A shared line stays, as often as it is there, in the document with the smallest
    ``doc_id`` that has it: in all rows of that id.  Where no holder has an id, it stays
    in one of the texts (and in all rows that equal it).  Repeated rows count as several
    documents and all come back.  The lines that stay are joined by line feeds, which may
    leave an empty text.
    """
    rows = texts(docs)
    rows = rows.select("*", *_hashes(_ROW, F.col("text"), F.col("doc_id")))
    # written, so that the join below has its own shuffle of the lines, which may be split
    shared = written(shared_lines(rows, min_chars, min_docs), "shared-lines")
    at = rows.select("doc_id", *_ROW, F.posexplode(_split("text")).alias("pos", "line"))
    key = normal_line(F.col("line"))
    places = at.filter(F.length(key) >= min_chars).select("doc_id", *_ROW, "pos", *_hashes(_LINE, key))
    holds = F.when(F.col("_holder").isNotNull(), F.col("doc_id") == F.col("_holder")).otherwise(
        F.col(_ROW[0]) == F.col("_unnamed")
    )
    dropped = (
        places.join(shared, list(_LINE))
        .filter(~F.coalesce(holds, F.lit(False)))
        .groupBy(*_ROW)
        # equal rows name the same positions
        .agg(F.collect_set("pos").alias("_dropped"))
    )

    def joined(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_dropped")
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    n_lines = F.size(_split("text")).cast("long")
    return rows.join(dropped, list(_ROW), "left").select(
        "doc_id",
        n_lines.alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(let(_split("text"), joined)).alias("text"),
    )
