"""Rows as keyed documents: ids, bulk lines and bulk actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.operators.nested import row_json

# --- ids ----------------------------------------------------------------------


def key_text(df: DataFrame, key: str) -> Column:
    """Text of a key column; booleans read ``True`` / ``False``, null is null."""
    c = F.col(f"`{key}`")
    if isinstance(df.schema[key].dataType, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    return c.cast("string")


def document_id(df: DataFrame, keys: Sequence[str], sep: str = "|", missing: str = "error") -> Column:
    """Document id from the key columns.

    A separator or backslash in a text key gets a backslash before it, so
    different keys have different ids; with ``sep=''`` they can share one (``1, 11``
    and ``11, 1``).  A missing key fails the job (``missing='error'``), makes the
    id null (``'null'``) or counts as empty text (``'empty'``; then null and ``''``
    share an id).
    """
    parts = []
    for key in keys:
        text = key_text(df, key)
        if sep and isinstance(df.schema[key].dataType, T.StringType):
            text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
            text = F.replace(text, F.lit(sep), F.lit("\\" + sep))
        if missing == "empty":
            text = F.coalesce(text, F.lit(""))
        elif missing == "error":
            text = F.coalesce(text, F.raise_error(F.lit(f"document without key {key}")).cast("string"))
        elif missing != "null":
            raise ValueError(f"unknown missing mode: {missing}")
        parts.append(text)
    pieces = [p for part in parts for p in (F.lit(sep), part)][1:]
    return F.concat(*pieces)


def document_ids(
    df: DataFrame,
    keys: Sequence[str],
    sep: str = "|",
    remove_keys: bool = False,
    missing: str = "error",
) -> DataFrame:
    """``(_id, source)``: each row as a JSON document under its id.

    ``remove_keys`` leaves the key columns out of the document.  With
    ``missing='null'`` rows without a complete key have no id; keep them apart
    with :func:`without_id`.
    """
    body = [c for c in df.columns if not (remove_keys and c in keys)]
    source = row_json(df, body) if body else F.lit("{}")
    return df.select(document_id(df, keys, sep, missing).alias("_id"), source.alias("source"))


def without_id(documents: DataFrame) -> DataFrame:
    """Documents that could not be given an id."""
    return documents.filter(F.col("_id").isNull())


def document_id_collisions(df: DataFrame, keys: Sequence[str], sep: str = "") -> DataFrame:
    """``(_id, n_keys)``: ids that more than one distinct key maps to."""
    return (
        df.select(*keys)
        .distinct()
        .select(document_id(df, keys, sep).alias("_id"))
        .groupBy("_id")
        .agg(F.count("*").alias("n_keys"))
        .filter(F.col("n_keys") > 1)
    )


# --- bulk lines ---------------------------------------------------------------


def action_line(op: str, id_col: Column) -> Column:
    """``{"<op>":{"_id":"..."}}``"""
    return F.to_json(F.struct(F.struct(id_col.alias("_id")).alias(op)))


def bulk_pairs(df: DataFrame, keys: Sequence[str], op: str = "index", **id_options) -> DataFrame:
    """One column ``value`` with the action line, a line feed and the source line.

    Keeping the pair in one value means a text sink can never part it.
    """
    docs = document_ids(df, keys, **id_options)
    return docs.select(F.concat_ws("\n", action_line(op, F.col("_id")), "source").alias("value"))


def bulk_lines(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "index", **id_options
) -> DataFrame:
    """``(*order, pos, line)``: action (``pos`` 0) and source (``pos`` 1) as two rows."""
    id_expr = document_id(
        df, keys, id_options.get("sep", "|"), id_options.get("missing", "empty")
    )
    body = [c for c in df.columns if not (id_options.get("remove_keys") and c in keys)]
    return df.select(
        *order, F.posexplode(F.array(action_line(op, id_expr), row_json(df, body))).alias("pos", "line")
    )


# --- bulk actions -------------------------------------------------------------

# Names that belong to the action line rather than the document.
_PLAIN_META = (
    "_id",
    "_index",
    "_percolate",
    "_timestamp",
    "_type",
    "if_seq_no",
    "if_primary_term",
    "parent",
    "pipeline",
    "retry_on_conflict",
    "routing",
    "version",
    "version_type",
)
# The same, written without the leading underscore.
_UNDERSCORED_META = (
    "_if_seq_no",
    "_if_primary_term",
    "_parent",
    "_retry_on_conflict",
    "_routing",
    "_version",
    "_version_type",
)
META_FIELDS = _PLAIN_META + _UNDERSCORED_META


def _meta_name(name: str) -> str:
    return name[1:] if name in _UNDERSCORED_META else name


def expand_actions(df: DataFrame, seq: str = "seq") -> DataFrame:
    """``(seq, op, _index, _id, action_line, source_line)`` from action columns.

    ``_op_type`` (default ``index``) names the operation, the metadata columns
    go to the action line, and the source is ``_source`` where present, else
    the remaining columns.  ``delete`` has no source.  An ``update`` whose
    ``_source`` is not a document passes it on as metadata.  A null column
    counts as absent.
    """
    columns = [c for c in df.columns if c != seq]
    op = F.coalesce(F.col("_op_type"), F.lit("index")) if "_op_type" in columns else F.lit("index")
    meta_columns = [c for c in META_FIELDS if c in columns]
    rest = [c for c in columns if c not in META_FIELDS and c not in ("_op_type", "_source")]
    body = row_json(df, rest) if rest else F.lit("{}")
    entries = [(F.lit(_meta_name(c)), F.col(f"`{c}`")) for c in meta_columns]
    if "_source" in columns:
        dtype = df.schema["_source"].dataType
        if isinstance(dtype, (T.StructType, T.MapType)):
            own = F.to_json("_source")
            is_document = F.lit(True)
        elif isinstance(dtype, T.VariantType):
            own = F.to_json("_source")
            is_document = F.startswith(own, F.lit("{"))
        else:
            # text: a JSON object is a document; anything else is a plain value
            own = F.col("_source").cast("string")
            is_document = F.startswith(F.ltrim(own), F.lit("{"))
        as_meta = (op == "update") & ~is_document & F.col("_source").isNotNull()
        if not isinstance(dtype, (T.StructType, T.MapType)):
            plain = F.col("_source").cast("variant")
            if isinstance(dtype, T.StringType):
                plain = F.coalesce(F.try_parse_json("_source"), plain)
            entries.append((F.lit("_source"), F.when(as_meta, plain)))
        source = F.when(F.col("_source").isNotNull() & ~as_meta, own).otherwise(body)
    else:
        source = body
    meta = _typed_meta(entries)
    line = F.concat(F.lit("{"), _json_text(op), F.lit(":"), meta, F.lit("}"))
    none = F.lit(None)
    index, doc_id = [F.col(c) if c in columns else none for c in ("_index", "_id")]
    return df.select(
        seq,
        op.alias("op"),
        index.cast("string").alias("_index"),
        doc_id.cast("string").alias("_id"),
        line.alias("action_line"),
        F.when(op != "delete", source).alias("source_line"),
    )


def _json_text(c: Column) -> Column:
    """JSON string literal of a text column."""
    wrapped = F.to_json(F.struct(c.alias("s")))
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)


def _typed_meta(entries: list[tuple[Column, Column]]) -> Column:
    """JSON object of the non-null entries, each value with its own type."""
    if not entries:
        return F.lit("{}")
    members = [
        F.when(
            value.isNotNull(),
            F.regexp_replace(F.to_json(F.struct(value.alias("v"))), r'^\{"v":|\}$', ""),
        )
        for _, value in entries
    ]
    named = [F.concat(_json_text(name), F.lit(":"), m) for (name, _), m in zip(entries, members)]
    return F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))


def expand_raw(df: DataFrame, col: str, seq: str = "seq") -> DataFrame:
    """Actions from ready source lines: each is indexed under an id given by the store."""
    none = F.lit(None).cast("string")
    return df.select(
        seq,
        F.lit("index").alias("op"),
        none.alias("_index"),
        none.alias("_id"),
        F.lit('{"index":{}}').alias("action_line"),
        F.col(col).alias("source_line"),
    )


def expand_json_actions(df: DataFrame, col: str, seq: str = "seq") -> DataFrame:
    """Like :func:`expand_actions` for actions given as JSON objects in a text column.

    Here a member that is present with the value null stays present.
    """
    entries = F.from_json(F.col(col), "map<string,variant>")
    tagged = df.select(seq, entries.alias("_a")).withColumns(
        {
            "_op": F.coalesce(F.expr("try_element_at(_a, '_op_type')::string"), F.lit("index")),
            "_src": F.expr("try_element_at(_a, '_source')"),
        }
    )
    has_source = F.expr("map_contains_key(_a, '_source')")
    src_is_object = F.startswith(F.to_json("_src"), F.lit("{"))
    as_meta = has_source & (F.col("_op") == "update") & ~src_is_object
    meta = F.transform_keys(
        F.map_filter("_a", lambda k, _: k.isin(*META_FIELDS) | ((k == "_source") & as_meta)),
        lambda k, _: F.when(k.isin(*_UNDERSCORED_META), F.substring(k, 2, 1 << 20)).otherwise(k),
    )
    rest = F.map_filter("_a", lambda k, _: ~k.isin("_op_type", "_source", *META_FIELDS))
    source = F.when(has_source & ~as_meta, F.to_json("_src")).otherwise(F.to_json(rest))
    keep_nulls = {"ignoreNullFields": "false"}
    return tagged.select(
        seq,
        F.col("_op").alias("op"),
        F.expr("try_element_at(_a, '_index')::string").alias("_index"),
        F.expr("try_element_at(_a, '_id')::string").alias("_id"),
        F.to_json(F.create_map("_op", meta), keep_nulls).alias("action_line"),
        F.when(F.col("_op") != "delete", source).alias("source_line"),
    )
