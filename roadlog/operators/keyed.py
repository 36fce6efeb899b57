"""Applying bulk actions to a document table.

A document is named by ``(_index, _id)``; its source is JSON text.  Tables and
actions without a column ``_index`` (or with null in it) belong to the index
``""``.  Actions are ``(op, _index, _id, source)`` and an order, by default the
column ``seq``; the source of an ``update`` is ``{"doc": {...}}``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.operators.nested import object_members
from roadlog.operators.ordered import BLOCK_BITS, last_before, positions
from roadlog.operators.search import directed
from roadlog.workspace import written

KEY = ("_index", "_id")

# place of the documents that are there before the first action
_BEFORE_ALL = -1

# the names of changed documents are broadcast up to this size (bytes, counted)
BROADCAST_BYTES = 32 << 20

OPERATIONS = ("index", "create", "update", "delete")


class Applied(NamedTuple):
    """The table after the actions, and one result row per action."""

    table: DataFrame
    results: DataFrame


def _index_of(df: DataFrame) -> Column:
    own = F.col("_index").cast("string") if "_index" in df.columns else F.lit(None).cast("string")
    return F.coalesce(own, F.lit("")).alias("_index")


def _documents(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        _index_of(df), F.col("_id").cast("string").alias("_id"), F.col("source").cast("string").alias("source"), *more
    )


def _shaped(df: DataFrame, *like: DataFrame) -> DataFrame:
    """Without ``_index`` if none of the inputs has it."""
    return df if any("_index" in x.columns for x in like) else df.drop("_index")


def _usable(op: Column, source: Column, named: Column) -> Column:
    """Whether an action can be applied to anything at all."""

    # what starts as an object and can be read is one
    readable = source.rlike(r"^\s*\{") & F.try_parse_json(source).isNotNull()
    partial = readable & F.startswith(F.get_json_object(source, "$.doc"), F.lit("{"))
    return F.coalesce(
        F.when(op.isin("index", "create"), readable).when(op == "update", partial & named).when(op == "delete", named),
        F.lit(False),
    )


def _numbered_actions(
    actions: DataFrame, order: Sequence[str], id_prefix: str | None, more: Sequence[str] = ()
) -> DataFrame:
    """The actions with their place in the order, an id each, and whether they are usable;
    columns named in ``more`` stay.

    The actions are written before they get their places: finding the ranges of an order
    goes through all rows once more, and must not make the actions and read their JSON a
    second time.  Made-up ids are part of that table, or follow from the place, so they
    stay what they are.
    """
    given, source = F.col("_id").cast("string"), F.col("source").cast("string")
    op = F.coalesce("op", F.lit("index"))
    sorted_by = [f"_order{i}" for i in range(len(order))]
    made = written(
        actions.select(
            *[F.col(c).alias(o) for c, o in zip(order, sorted_by)],
            *([F.col("seq").cast("long").alias("seq")] if "seq" in actions.columns else []),
            op.alias("op"),
            _index_of(actions),
            (given if id_prefix is not None else F.coalesce(given, F.uuid())).alias("_id"),
            given.isNotNull().alias("_named"),
            _usable(op, source, given.isNotNull()).alias("_usable"),
            source.alias("source"),
            *more,
        ),
        "actions",
    )
    placed = positions(made, sorted_by, "_place")
    if id_prefix is not None:
        own = F.concat(F.lit(id_prefix), F.lit("-"), F.col("_place"))
        placed = placed.withColumn("_id", F.coalesce("_id", own))
    return placed.drop(*sorted_by)


def _with_status(acts: DataFrame, target: DataFrame, block_bits: int) -> DataFrame:
    """``_place, op, *KEY, status`` of every action, from narrow columns alone."""
    narrow = acts.select("_place", "op", *KEY, "_named", "_usable")
    named = narrow.select(*KEY).distinct()
    there = target.select(*KEY).join(named, list(KEY), "left_semi").select(
        F.lit(_BEFORE_ALL).cast("long").alias("_place"),
        F.lit("index").alias("op"),
        *KEY,
        F.lit(True).alias("_named"),
        F.lit(True).alias("_usable"),
    )
    op = F.col("op")
    # presence after an action depends on the last usable action that is no update;
    # a refused create still tells that the document is there
    marker = F.when(F.col("_usable"), F.when(op.isin("index", "create"), 1).when(op == "delete", 0))
    scored = last_before(there.unionByName(narrow), KEY, "_place", marker, "_marker", block_bits)
    present = F.coalesce(F.col("_marker"), F.lit(0)) == 1
    status = (
        F.when(~F.col("_usable"), 400)
        # an id that was made up must not meet a document
        .when((op == "index") & present, F.when(F.col("_named"), 200).otherwise(409))
        .when((op == "create") & present, 409)
        .when(op.isin("index", "create"), 201)
        .when(present, 200)
        .otherwise(404)
    )
    return scored.filter(F.col("_place") > _BEFORE_ALL).select("_place", "op", *KEY, status.alias("status"))


class _Number(str):
    """A number as it is written."""


def _json_text(value) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{_json_text(k)}:{_json_text(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_json_text, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def _json_value(text: str):
    return json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_Number)


@F.pandas_udf(T.StringType())
def _merge_members(source: pd.Series, members: pd.Series) -> pd.Series:
    """Write ``[{"path": [...], "value": "<json>"}]`` into JSON objects, in order.

    What is no object counts as an empty one; numbers keep their spelling.
    """

    def one(text, writes):
        if writes is None:
            return text
        doc = _json_value(text) if text else {}
        if not isinstance(doc, dict):
            doc = {}
        for write in json.loads(writes):
            *parents, name = write["path"]
            at = doc
            for p in parents:
                if not isinstance(at.get(p), dict):
                    at[p] = {}
                at = at[p]
            value = _json_value(write["value"])
            if value == {} and isinstance(at.get(name), dict):
                continue
            at[name] = value
        return _json_text(doc)

    return pd.Series([one(t, w) for t, w in zip(source, members)], dtype=object)


def _are_few(names: DataFrame) -> bool:
    """Whether the counted size of distinct names allows to broadcast them."""
    size = names.agg(F.sum(F.octet_length("_index") + F.octet_length("_id") + 16)).first()[0] or 0
    return size <= BROADCAST_BYTES


def apply_actions(
    target: DataFrame,
    actions: DataFrame,
    order: Sequence[str] = ("seq",),
    id_prefix: str | None = None,
    block_bits: int = BLOCK_BITS,
) -> Applied:
    """Apply index / create / update / delete actions in their order, document by document.

    ``index`` replaces the document, ``create`` is refused (409) when it is
    there, ``update`` merges a partial document and ``delete`` removes it; both
    give 404 when it is not there.  An action whose source is no JSON object, an
    unknown operation, and an update or delete without id give 400 and change
    nothing.  Other actions without id get one of their own (a UUID, or
    ``id_prefix`` and their place); should a document have that id, 409.

    Windows see the narrow columns only, and of the target only the documents
    that are named.  Documents that no action changes are passed through; the
    names of the changed ones are broadcast when their size allows.  What a changed
    document looks like follows from its last replacement and, per member, the
    last update after it; both are aggregates with a map-side part.  Only
    documents with such updates pass through Python, with one entry per member.

    The actions in their order, the statuses and the last replacements are tables in
    the shared folder; both results read them.
    """
    before = _documents(target)
    acts = _numbered_actions(actions, order, id_prefix)
    scored = written(_with_status(acts, before, block_bits), "statuses")
    table = _shaped(_final_documents(before, acts, scored), target, actions)
    return Applied(table, _shaped(_results(acts, scored), target, actions))


def _base() -> Column:
    """Aggregate over the successful actions of a document: the place of its last
    replacement or removal, if there is one."""
    return F.max(F.when(F.col("op") != "update", F.col("_place"))).alias("_base")


def _final_documents(
    before: DataFrame, acts: DataFrame, scored: DataFrame, bases: DataFrame | None = None
) -> DataFrame:
    """``bases``, if known: ``*KEY, _base`` of all documents with a successful action."""
    done = scored.filter(F.col("status") < 300)
    if bases is None:
        bases = written(done.groupBy(*KEY).agg(_base()), "bases")
    replaced = (
        acts.select("_place", "op", "source")
        .join(bases.select(F.col("_base").alias("_place"), *KEY), "_place")
        .filter(F.col("op") != "delete")
        .select(*KEY, "source")
    )
    names, updated = bases.select(*KEY), bases.filter(F.col("_base").isNull()).select(*KEY)
    if _are_few(names):
        names, updated = F.broadcast(names), F.broadcast(updated)
    updated_only = before.join(updated, list(KEY), "left_semi")
    untouched = before.join(names, list(KEY), "left_anti")
    partial = F.expr("variant_get(parse_json(source), '$.doc', 'variant')").alias("doc")
    updates = (
        acts.select("_place", "source")
        .join(done.filter(F.col("op") == "update").select("_place", *KEY), "_place")
        .join(bases, list(KEY))
        .filter(F.col("_place") > F.coalesce("_base", F.lit(_BEFORE_ALL)))
        .select(*KEY, F.col("_place").alias("place"), partial)
    )
    members = (
        object_members(updates, "doc", [*KEY, "place"])
        # an empty object only makes sure that the member is an object, so it
        # must not hide an earlier plain value of the same member
        .withColumn("hollow", F.col("value") == "{}")
        .groupBy(*KEY, "path", "hollow")
        .agg(F.max_by("value", "place").alias("value"), F.max("place").alias("place"))
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("place", "path", "value"))).alias("_writes"))
    )
    changed = replaced.unionByName(updated_only).join(members, list(KEY), "left")
    writes = F.when(
        F.size("_writes") > 0,
        F.to_json(F.transform("_writes", lambda w: F.struct(w["path"].alias("path"), w["value"].alias("value")))),
    )
    source = F.when(writes.isNotNull(), _merge_members(F.when(writes.isNotNull(), F.col("source")), writes))
    return untouched.unionByName(changed.select(*KEY, F.coalesce(source, F.col("source")).alias("source")))


# Error names per status.
_ERRORS = {
    400: "action_request_validation_exception",
    404: "document_missing_exception",
    409: "version_conflict_engine_exception",
}


def error_name(status: Column) -> Column:
    """Name of the error behind a status; null for a success."""
    name = F.lit(None).cast("string")
    for code, text in _ERRORS.items():
        name = F.when(status == code, text).otherwise(name)
    return name


def _results(acts: DataFrame, scored: DataFrame) -> DataFrame:
    ok = F.col("status").between(200, 299)
    status = scored.select("_place", "status")
    return acts.join(status, "_place").select(
        *(["seq"] if "seq" in acts.columns else [F.col("_place").alias("seq")]),
        "op",
        *KEY,
        "status",
        ok.alias("ok"),
        error_name(F.col("status")).alias("error"),
        F.when(~ok, F.col("source")).alias("source"),
    )


def last_write_wins(target: DataFrame, actions: DataFrame) -> DataFrame:
    """The table after actions ``(seq unique, op, _index, _id, source)`` that are all
    ``index`` or ``delete``.

    Which action is the last follows from ``seq`` alone (one narrow hash
    aggregate); only then the sources are fetched.  An ``index`` without id gets
    one of its own, a ``delete`` without id fails.  Further columns of the
    actions become columns of their documents.
    """
    extra = [c for c in actions.columns if c not in ("seq", "op", "source", *KEY)]
    op = F.coalesce("op", F.lit("index"))
    known = F.when(op.isin("index", "delete"), op).otherwise(
        F.raise_error(F.concat(F.lit("not an index or delete action: "), op)).cast("string")
    )
    no_name = F.raise_error(F.lit("a delete needs an id")).cast("string")
    acts = written(
        actions.select(
            F.col("seq").cast("long").alias("seq"),
            known.alias("op"),
            _index_of(actions),
            F.coalesce(
                F.col("_id").cast("string"), F.when(op == "index", F.uuid()).otherwise(no_name)
            ).alias("_id"),
            F.col("source").cast("string").alias("source"),
            *extra,
        ),
        "writes",
    )
    last = acts.groupBy(*KEY).agg(F.max("seq").alias("seq"))
    written_docs = (
        acts.filter(F.col("op") == "index").join(last, [*KEY, "seq"], "left_semi").select(*KEY, "source", *extra)
    )
    kept = [c for c in target.columns if c not in ("source", *KEY)]
    names = last.select(*KEY)
    untouched = _documents(target, *kept).join(F.broadcast(names) if _are_few(names) else names, list(KEY), "left_anti")
    return _shaped(untouched.unionByName(written_docs, allowMissingColumns=True), target, actions)


def outcome_tally(results: DataFrame, by_operation: bool = True) -> DataFrame:
    """``(op, success, failed)`` counts, or one row ``(success, failed)``."""
    counts = [F.count_if("ok").alias("success"), F.count_if(~F.col("ok")).alias("failed")]
    return results.groupBy("op").agg(*counts) if by_operation else results.agg(*counts)


def failures(results: DataFrame) -> DataFrame:
    """Result rows of the actions that failed."""
    return results.filter(~F.col("ok"))


def raise_on_failure(results: DataFrame) -> DataFrame:
    """The results; the job fails when it meets a failed action."""
    message = F.concat_ws(" ", F.lit("action failed:"), "op", "_id", F.col("status").cast("string"), "error")
    checked = F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return results.withColumn("ok", checked)


def raise_on_failed_chunks(results: DataFrame, chunks: DataFrame) -> DataFrame:
    """The results with their ``chunk``; the job fails when it meets a chunk with failed
    actions, and tells all of them.

    ``chunks`` has ``seq, chunk`` (:func:`roadlog.operators.bulk.chunk_stream`), whose
    sizes bound what is gathered.
    """
    failed = F.when(~F.col("ok"), F.struct("seq", "op", "_id", "status", "error"))
    of_chunk = F.array_sort(F.collect_list(failed).over(Window.partitionBy("chunk")))
    message = F.concat(F.size("_failed"), F.lit(" document(s) failed to index: "), F.to_json("_failed"))
    checked = F.when(F.size("_failed") == 0, F.col("ok")).otherwise(F.raise_error(message).cast("boolean"))
    together = results.join(chunks.select("seq", "chunk"), "seq").withColumn("_failed", of_chunk)
    return together.withColumn("ok", checked).drop("_failed")


# --- whole-table maintenance --------------------------------------------------


class Reindexed(NamedTuple):
    """The target after a reindex, and one row ``(success, failed)``."""

    table: DataFrame
    tally: DataFrame


def reindex_documents(
    src: DataFrame,
    predicate: Column | str | None,
    target_name: str,
    max_docs: int | None = None,
) -> DataFrame:
    """The matching documents, addressed to ``target_name``.

    The members of a STRUCT column ``fields`` become columns of the document,
    replacing columns of the same name.
    """
    hits = src if predicate is None else src.filter(predicate)
    if max_docs is not None:
        hits = hits.limit(max_docs)
    lifted = {}
    if "fields" in hits.columns:
        lifted = {n: F.col(f"fields.`{n}`") for n in hits.schema["fields"].dataType.fieldNames()}
        hits = hits.withColumns(lifted).drop("fields")
    return hits.withColumn("_index", F.lit(target_name))


def reindex(
    src: DataFrame,
    target: DataFrame,
    predicate: Column | str | None,
    target_name: str,
    max_docs: int | None = None,
) -> Reindexed:
    """Copy the matching documents of ``src`` over those of ``target``.

    Both are document tables; the copies are named ``(target_name, _id)`` when the
    target has a column ``_index``.  Columns lifted from ``fields`` stay beside the
    source.  Copying never fails on a document, so the tally only counts successes.
    """
    docs = reindex_documents(src, predicate, target_name, max_docs)
    if "_index" not in target.columns:
        docs = docs.drop("_index")
    moved = docs.withColumns({"seq": F.monotonically_increasing_id(), "op": F.lit("index")})
    tally = docs.agg(F.count("*").alias("success"), F.lit(0).cast("long").alias("failed"))
    return Reindexed(last_write_wins(target, moved), tally)


def _matches(predicate: Column | str) -> Column:
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(p, F.lit(False))


def _name(df: DataFrame) -> tuple[str, ...]:
    """The columns that name a document."""
    return KEY if "_index" in df.columns else ("_id",)


def _first_matching(
    df: DataFrame, hit: Column, n: int, order: Sequence[str], key: Sequence[str], marker: str
) -> DataFrame:
    """``df`` with ``marker``: whether the row is one of the first ``n`` that match.

    The order (``field``, ``field:asc`` or ``field:desc``, missing values last) is
    completed by the key.  Places are found from sorted ranges of the keys that match and
    the number of rows in each, so ``n`` may be any part of the table.
    """
    named = [f"_key{i}" for i in range(len(key))]
    narrow, sort = [F.col(c).alias(k) for c, k in zip(key, named)], []
    for i, item in enumerate(order):
        name, _, direction = item.partition(":")
        narrow.append(F.col(name).alias(f"_order{i}"))
        sort.append(directed(F.col(f"_order{i}"), item, direction))
    ranked = positions(df.filter(hit).select(*narrow), [*sort, *named], "_rank").filter(F.col("_rank") < n)
    first = ranked.select(*named, F.lit(True).alias(marker)).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(key, named)])
    return df.join(first, same, "left").withColumn(marker, F.coalesce(marker, F.lit(False)) & hit).drop(*named)


def delete_where(
    df: DataFrame,
    predicate: Column | str,
    max_docs: int | None = None,
    order: Sequence[str] = (),
    key: Sequence[str] | None = None,
) -> DataFrame:
    """The rows that do not match.  A predicate that is null keeps the row.

    ``max_docs`` removes only the first matching rows in ``order`` (then by ``key``:
    ``_index``, where there is one, and ``_id``).  A name stands for one document: rows
    that share it and match go together; a null in it is a value like any other.
    """
    hit = _matches(predicate)
    if max_docs is None:
        return df.filter(~hit)
    return _first_matching(df, hit, max_docs, order, key or _name(df), "_gone").filter(~F.col("_gone")).drop("_gone")


def update_where(
    df: DataFrame,
    predicate: Column | str,
    changes: Mapping[str, Column | str],
    max_docs: int | None = None,
    order: Sequence[str] = (),
    key: Sequence[str] | None = None,
) -> DataFrame:
    """All rows, with the changes applied to those that match.

    Every change sees the row as it was before.  ``max_docs``, ``order`` and ``key`` are
    as in :func:`delete_where`.
    """
    hit = _matches(predicate)
    if max_docs is not None:
        df = _first_matching(df, hit, max_docs, order, key or _name(df), "_hit")
        hit = F.col("_hit")
    new = {c: F.expr(e) if isinstance(e, str) else e for c, e in changes.items()}
    kept = {c: F.col(c) if c in df.columns else F.lit(None) for c in new}
    changed = df.withColumns({c: F.when(hit, e).otherwise(kept[c]) for c, e in new.items()})
    return changed if max_docs is None else changed.drop("_hit")


def match_tally(df: DataFrame, predicate: Column | str, max_docs: int | None = None) -> DataFrame:
    """One row ``(total, matched)`` for a delete or update by predicate; at most
    ``max_docs`` are matched."""
    matched = F.count_if(_matches(predicate))
    if max_docs is not None:
        matched = F.least(matched, F.lit(max_docs).cast("long"))
    return df.agg(F.count("*").alias("total"), matched.alias("matched"))
