"""Looking things up in document tables.  Predicates are Spark columns or SQL text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlog.functions.paths import project_paths
from roadlog.operators.nested import schema_profile

Predicate = Column | str | None


def _matching(df: DataFrame, predicate: Predicate) -> DataFrame:
    return df if predicate is None else df.filter(predicate)


def _sort_columns(df: DataFrame, sort: Sequence[str | Column]) -> list[Column]:
    """``field`` or ``field:asc`` / ``field:desc``; missing values come last."""
    columns = []
    for item in sort:
        if isinstance(item, Column):
            columns.append(item)
            continue
        name, _, direction = item.partition(":")
        columns.append(directed(F.col(name), item, direction))
    return columns


def directed(c: Column, item: str, direction: str) -> Column:
    if direction not in ("", "asc", "desc"):
        raise ValueError(f"unknown sort direction: {item}")
    return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last()


def scan_documents(
    docs: DataFrame,
    predicate: Predicate = None,
    preserve_order: bool = False,
    sort: Sequence[str | Column] = ("_id",),
) -> DataFrame:
    """Every matching document; sorted only if ``preserve_order``."""
    hits = _matching(docs, predicate)
    return hits.orderBy(*_sort_columns(docs, sort)) if preserve_order else hits


def search_page(
    docs: DataFrame,
    predicate: Predicate = None,
    sort: Sequence[str | Column] = (),
    offset: int = 0,
    size: int = 10,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    source_includes: Sequence[str] = (),
    source_excludes: Sequence[str] = (),
) -> DataFrame:
    """One page of the matching documents.

    With a sort the page is a distributed top-k of ``offset + size`` rows.  The last two
    arguments are paths inside ``source`` (:func:`roadlog.functions.paths.project_paths`);
    only the sources of the page are cut.
    """
    hits = _matching(docs, predicate)
    if sort:
        hits = hits.orderBy(*_sort_columns(docs, sort))
    page = hits.offset(offset).limit(size) if offset else hits.limit(size)
    shown = [c for c in (columns or docs.columns) if c not in exclude]
    page = page.select(*shown)
    if (source_includes or source_excludes) and "source" in shown:
        page = page.withColumn("source", project_paths(F.col("source"), source_includes, source_excludes))
    return page


def match_count(docs: DataFrame, predicate: Predicate = None) -> DataFrame:
    """One row ``count``: the number of matching documents."""
    return _matching(docs, predicate).agg(F.count("*").alias("count"))


@dataclass(frozen=True)
class Search:
    """Arguments of :func:`search_page`."""

    predicate: Predicate = None
    sort: Sequence[str] = ()
    offset: int = 0
    size: int = 10
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = field(default_factory=tuple)


def multi_search(docs: DataFrame, searches: Mapping[str, Search]) -> DataFrame:
    """The pages of several searches, each row tagged with ``search``.

    One scan serves all: a row is tagged with every search it matches and ranked
    inside each (Spark keeps only the first ``offset + size`` of a task before the
    shuffle).  Columns that a search does not show are null.
    """

    def matches(s: Search) -> Column:
        if s.predicate is None:
            return F.lit(True)
        p = F.expr(s.predicate) if isinstance(s.predicate, str) else s.predicate
        return F.coalesce(p, F.lit(False))

    def shown(s: Search) -> list[str]:
        return [c for c in (s.columns or docs.columns) if c not in s.exclude]

    tags = F.array_compact(F.array(*[F.when(matches(s), F.lit(name)) for name, s in searches.items()]))
    # within a search only its own sort columns differ from row to row
    order = []
    for name, s in searches.items():
        for item in s.sort:
            column, _, direction = item.partition(":")
            own = F.when(F.col("search") == name, F.col(column))
            order.append(directed(own, item, direction))
    rank = F.row_number().over(Window.partitionBy("search").orderBy(*order or [F.lit(0)]))
    # a plain number first, so that the ranks can be limited before the shuffle
    most = max(s.offset + s.size for s in searches.values())
    tagged = docs.withColumn("search", F.explode(tags)).withColumn("_rank", rank).filter(F.col("_rank") <= most)
    on_page = reduce(
        lambda a, b: a | b,
        [
            (F.col("search") == name) & (F.col("_rank") > s.offset) & (F.col("_rank") <= s.offset + s.size)
            for name, s in searches.items()
        ],
    )
    columns = list(dict.fromkeys(c for s in searches.values() for c in shown(s)))

    def visible(c: str) -> Column:
        names = [name for name, s in searches.items() if c in shown(s)]
        return F.when(F.col("search").isin(names), F.col(c)).alias(c)

    return tagged.filter(on_page).select("search", *[visible(c) for c in columns])


# --- lookups by id ------------------------------------------------------------

Key = str | Sequence[str]


def _names(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _hits(docs: DataFrame, ids: DataFrame, key: list[str]) -> DataFrame:
    """Documents whose id is asked for.

    The semi join keeps the table in place when the ids are few (Spark
    broadcasts them after checking their size) and shuffles both otherwise.
    """
    return docs.join(ids.select(*key).distinct(), key, "left_semi")


def lookup(docs: DataFrame, ids: DataFrame | Sequence, key: Key = "_id") -> DataFrame:
    """One row per requested id (repeats included): the document and ``found``.

    ``key`` may be several columns, as ``("_index", "_id")``; a null in them is found
    nowhere.  A list of ids (tuples for several columns) passes the driver and the plan,
    so it is for a few written by hand; give a DataFrame otherwise.  A table that is
    looked up again and again is better kept in :mod:`roadlog.operators.store`, which
    reads only the buckets of the ids.
    """
    key = _names(key)
    if not isinstance(ids, DataFrame):
        wanted = [i if isinstance(i, tuple) else (i,) for i in ids]
        schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key)
        # of several columns each narrows the scan by itself
        for column, values in zip(key, zip(*wanted)):
            docs = docs.filter(F.col(column).isin(list(set(values))))
        ids = docs.sparkSession.createDataFrame(wanted, schema)
    found = _hits(docs, ids, key)
    return (
        ids.select(*key)
        .join(found.withColumn("found", F.lit(True)), key, "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
    )


def existing_ids(docs: DataFrame, ids: DataFrame, key: Key = "_id") -> DataFrame:
    """The requested ids that are in the table."""
    key = _names(key)
    return ids.join(_hits(docs.select(*key), ids, key), key, "left_semi")


def missing_ids(docs: DataFrame, ids: DataFrame, key: Key = "_id") -> DataFrame:
    """The requested ids that are not in the table."""
    key = _names(key)
    return ids.join(_hits(docs.select(*key), ids, key), key, "left_anti")


def exists_ids(docs: DataFrame, ids: DataFrame, key: Key = "_id") -> DataFrame:
    """``(*key, found)`` for each requested id."""
    key = _names(key)
    found = _hits(docs.select(*key), ids, key).distinct().withColumn("found", F.lit(True))
    return ids.select(*key).join(found, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


# --- fields across tables -----------------------------------------------------


def declared_fields(df: DataFrame, index: str) -> DataFrame:
    """``(index, field, type)`` of a table's columns, from its schema alone."""
    return df.sparkSession.createDataFrame(
        [(index, f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "index string, field string, type string",
    )


def observed_fields(df: DataFrame, col: str, index: str) -> DataFrame:
    """``(index, field, type)`` found in the documents of a column."""
    return schema_profile(df, col).select(
        F.lit(index).alias("index"), F.col("path").alias("field"), "type"
    )


def fields_by_index(docs: DataFrame, col: str = "source") -> DataFrame:
    """``(index, field, type)`` found in a table of documents of several indices, in one pass.

    A missing ``_index`` is the index ``""``.
    """
    named = docs.withColumn("_index", F.coalesce(F.col("_index").cast("string"), F.lit("")))
    return schema_profile(named, col, ("_index",)).select(
        F.col("_index").alias("index"), F.col("path").alias("field"), "type"
    )


def field_caps(*fields: DataFrame) -> DataFrame:
    """``(field, type, indices)``: in which tables a field has which type.

    ``indices`` is sorted; it has at most one entry per table given.
    """
    together = reduce(DataFrame.unionByName, fields)
    return together.groupBy("field", "type").agg(F.array_sort(F.collect_set("index")).alias("indices"))
