"""Nested JSON: flattening, lenient decoding, schema profiles, encoding."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# SQL fragments about one VARIANT `{v}`
_AS_OBJECT = "try_cast({v} AS MAP<STRING, VARIANT>)"
_AS_LIST = "try_cast({v} AS ARRAY<VARIANT>)"



def _text_of(df: DataFrame, col: str) -> Column | None:
    """The JSON text of a column that is none of VARIANT."""
    return None if isinstance(df.schema[col].dataType, T.VariantType) else F.col(col)


def _as_variant(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.VariantType):
        return F.col(col)
    return F.try_parse_json(F.col(col))


# SQL text: patterns of a JSON string, and of everything but brackets
_STRING = r"""r'"(?:[^"\\]|\\[\s\S])*+"'"""
_NO_BRACKET = r"""r'[^{}\[\]]'"""


# a text with at most so many opening brackets is not looked at further for its depth
_FEW_LEVELS = 16


def _levels(text: str) -> str:
    """SQL text: so many levels open every node of a JSON text.

    Opening brackets, wherever they stand, are no fewer than levels, and a level that
    opens nothing costs next to nothing, so only texts with many are measured.
    """
    opening = "length(t) - length(translate(t, '{[', ''))"
    return (
        f"transform(array({text}), t -> CASE WHEN {opening} <= {_FEW_LEVELS} THEN {opening} "
        f"ELSE {_depth('t')} END)[0]"
    )


def _depth(text: str) -> str:
    """SQL text: how deep a JSON text nests.  Only brackets outside of strings count."""
    brackets = f"regexp_replace(regexp_replace({text}, {_STRING}, ''), {_NO_BRACKET}, '')"
    move = "CASE WHEN b IN ('{', '[') THEN 1 WHEN b IN ('}', ']') THEN -1 ELSE 0 END"
    return (
        f"aggregate(split({brackets}, ''), named_struct('at', 0, 'most', 0), "
        f"(a, b) -> named_struct('at', a.at + {move}, 'most', greatest(a.most, a.at + {move})), a -> a.most)"
    )


def _open_level(nodes: str, into_lists: bool, keep_objects: bool) -> str:
    """SQL text: the array ``nodes`` with every open container replaced by its members.

    A node is ``(path ARRAY<STRING>, value VARIANT, done BOOLEAN)``.
    """
    # SQL text keeps the lambda readable; `n` is the node
    members = (
        "transform(map_entries(" + _AS_OBJECT.format(v="n.value") + "), "
        "e -> named_struct('path', array_append(n.path, e.key), 'value', e.value, 'done', false))"
    )
    closed = "array(named_struct('path', n.path, 'value', n.value, 'done', true))"
    if keep_objects:
        members = f"concat({closed}, {members})"
    as_list = _AS_LIST.format(v="n.value")
    elements = (
        f"transform({as_list}, (x, i) -> named_struct("
        "'path', array_append(n.path, cast(i AS STRING)), 'value', x, 'done', false))"
    )
    has_object = f"exists({as_list}, x -> {_AS_OBJECT.format(v='x')} IS NOT NULL)"
    open_list = f"WHEN {has_object} THEN {elements}" if into_lists else ""
    step = (
        f"CASE WHEN n.done THEN {closed} "
        f"WHEN {_AS_OBJECT.format(v='n.value')} IS NOT NULL THEN {members} "
        f"{open_list} ELSE {closed} END"
    )
    # documents that are open no more skip the remaining levels
    return f"CASE WHEN exists({nodes}, n -> NOT n.done) THEN flatten(transform({nodes}, n -> {step})) ELSE {nodes} END"


def _step_to(key: str) -> str | None:
    """The step of a variant path to a member; None if it cannot be said."""
    if key.isascii() and key.isidentifier():
        return f".{key}"
    return f"['{key}']" if key and not set(key) & set("'?") else None


def _node_paths(text: str | None, into_lists: bool, keep_objects: bool) -> list[list[str]] | None:
    """Of every node of a deep JSON text the variant path, then its parts, parents first and
    members in the order of a VARIANT.  None of one with few levels, or with a member that
    no variant path can name."""
    if text is None:
        return None
    try:
        # numbers stay text: only the shape is looked at
        doc = json.loads(text, parse_int=str, parse_float=str)
    except (ValueError, RecursionError):
        return None
    found, deep = [], False
    # the way to the node at hand, and nodes with their place on it
    steps, parts = ["$"], []
    open_nodes = [(0, "$", None, doc)]
    while open_nodes:
        level, step, part, value = open_nodes.pop()
        if level:
            steps[level:], parts[level - 1 :] = (step,), (part,)
        if isinstance(value, dict):
            if keep_objects:
                found.append(["".join(steps), *parts])
            names = sorted(value)
            if not "".join(names).isascii():
                names.sort(key=lambda k: k.encode("utf-16-be", "surrogatepass"))
            said = [_step_to(k) for k in names]
            if None in said:
                return None
            members = [(level + 1, step, k, value[k]) for k, step in zip(names, said)]
        elif into_lists and isinstance(value, list) and any(isinstance(x, dict) for x in value):
            members = [(level + 1, f"[{i}]", str(i), x) for i, x in enumerate(value)]
        else:
            found.append(["".join(steps), *parts])
            continue
        deep |= level >= _FEW_LEVELS
        open_nodes.extend(reversed(members))
    return found if deep else None


def _paths_of(text: Column, into_lists: bool, keep_objects: bool) -> Column:
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def paths(texts: pd.Series) -> pd.Series:
        return pd.Series([_node_paths(t, into_lists, keep_objects) for t in texts], dtype=object)

    return paths(text)


def _nodes(df: DataFrame, doc: Column, into_lists: bool, keep_objects: bool, text: Column | None = None) -> DataFrame:
    """Add ``_nodes``: all nodes of each document; ``text`` is its JSON, if it is at hand.

    The work stays inside the row (no shuffle, one scan).  Documents of few levels are
    opened level by level.  Each level copies what is below it, so the nodes of deep ones
    are fetched from the whole document by their paths.
    """
    text = F.to_json(doc) if text is None else text
    df = df.withColumns(
        {
            "_nodes": F.array(
                F.struct(
                    F.array().cast("array<string>").alias("path"),
                    doc.alias("value"),
                    F.lit(False).alias("done"),
                )
            ),
            "_text": text,
        }
    )
    opening = F.length("_text") - F.length(F.translate("_text", "{[", ""))
    df = df.withColumn("_paths", _paths_of(F.when(opening > _FEW_LEVELS, F.col("_text")), into_lists, keep_objects))
    opened = _open_level("nodes", into_lists, keep_objects)
    depth = f"greatest(1, coalesce({_levels('_text')}, 1))"
    # array(x) gives a name to x, which is not evaluated again for every node
    by_path = (
        "transform(array(_nodes[0].value), d -> transform(_paths, p -> named_struct("
        "'path', slice(p, 2, size(p) - 1), 'value', variant_get(d, p[0], 'variant'), 'done', true)))[0]"
    )
    by_level = f"aggregate(sequence(1, {depth}), _nodes, (nodes, level) -> {opened})"
    found = (
        f"transform(array(CASE WHEN _paths IS NOT NULL AND _nodes[0].value IS NOT NULL THEN {by_path} END), "
        "f -> CASE WHEN f IS NOT NULL AND NOT exists(f, n -> n.value IS NULL) THEN f "
        f"ELSE {by_level} END)[0]"
    )
    return df.withColumn("_nodes", F.expr(found)).drop("_text", "_paths")


def _dotted(nodes: str, value: str = "n.value") -> Column:
    """Nodes with their path as dotted text; of equal paths the last one stays."""
    pairs = f"transform({nodes}, n -> named_struct('path', array_join(n.path, '.'), 'value', {value}))"
    # the places of the last of each path: sorted by path and place, the next has another path
    places = "array_sort(transform(pairs, (p, i) -> named_struct('path', p.path, 'i', i)))"
    last = (
        f"array_sort(transform(filter(transform(array({places}), s -> "
        "transform(s, (p, k) -> named_struct('i', p.i, 'last', get(s, k + 1).path IS DISTINCT FROM p.path)))[0], "
        "p -> p.last), p -> p.i))"
    )
    return F.expr(
        f"transform(array({pairs}), pairs -> CASE WHEN size(array_distinct(transform(pairs, p -> p.path))) = size(pairs) "
        f"THEN pairs ELSE transform({last}, i -> pairs[i]) END)[0]"
    )


def flatten_json(df: DataFrame, col: str, id_cols: Sequence[str] = ()) -> DataFrame:
    """Long form of nested documents: ``(*id_cols, path, value VARIANT)``.

    Objects become dotted paths.  A list with at least one object directly in
    it is indexed (``d.1.e``); any other list stays whole.  Empty objects give
    nothing, empty lists and nulls are kept, a bare scalar has the path ``""``.
    ``col`` is a VARIANT, or text of which undecodable rows give nothing.
    """
    opened = _nodes(df, _as_variant(df, col), into_lists=True, keep_objects=False, text=_text_of(df, col))
    # outer: a plain generator makes Spark test the array beforehand, which
    # would open each document a second time
    pairs = opened.withColumn("_pairs", _dotted("_nodes")).select(*id_cols, F.inline_outer("_pairs"))
    return pairs.filter(F.col("value").isNotNull())


def flatten_wide(df: DataFrame, col: str, paths: Sequence[str]) -> DataFrame:
    """Add one text column per wanted flattened path (scalars bare, lists as JSON)."""
    opened = _nodes(df, _as_variant(df, col), into_lists=True, keep_objects=False, text=_text_of(df, col))
    flat = opened.withColumn("_flat", F.map_from_entries(_dotted("_nodes", variant_text("n.value"))))
    return flat.select(*df.columns, *[F.try_element_at("_flat", F.lit(p)).alias(p) for p in paths])


def variant_text(value: str) -> str:
    """SQL text: a scalar VARIANT as bare text, a container as JSON, null as null."""
    return f"coalesce(try_cast({value} AS STRING), CASE WHEN NOT is_variant_null({value}) THEN to_json({value}) END)"


def flatten_struct(df: DataFrame) -> DataFrame:
    """Flatten STRUCT columns of a known type into dotted columns, one projection."""

    def walk(fields, prefix, name):
        for f in fields:
            at, label = prefix + [f.name], f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType.fields, at, label + ".")
            else:
                yield F.col(".".join(f"`{p}`" for p in at)).alias(label)

    return df.select(*walk(df.schema.fields, [], ""))


# --- lenient decoding ---------------------------------------------------------


_RETRIED = T.StructType([T.StructField("text", T.StringType()), T.StructField("path", T.StringType())])


@F.pandas_udf(_RETRIED)
def _retry(text: pd.Series) -> pd.DataFrame:
    """Strict JSON text, and how it was found, of what Spark does not take as JSON.

    JSON with NaN or Infinity is JSON to Python; as in `to_json` they become text.
    """
    readers = (("json", lambda t: json.loads(t, parse_constant=str)), ("literal", ast.literal_eval))

    def one(t):
        for path, read in readers if t is not None else ():
            try:
                return json.dumps(read(t), allow_nan=False), path
            except Exception:  # any text may turn up here; what no reader takes is reported as failed
                continue
        return None, None

    return pd.DataFrame([one(t) for t in text], columns=["text", "path"], dtype=object)


def decode_tolerant(df: DataFrame, col: str) -> DataFrame:
    """Add ``doc`` (VARIANT) and ``decode_path`` (``json``, ``literal`` or ``failed``).

    JSON is decoded by Spark.  Only the text that is not JSON is sent to Python
    to be read as a Python literal; what is neither becomes ``{}``.
    """
    parsed = df.withColumn("_json", F.try_parse_json(col))
    retried = parsed.withColumn("_retried", _retry(F.when(F.col("_json").isNull(), F.col(col)))).withColumn(
        "_second", F.try_parse_json("_retried.text")
    )
    return retried.withColumns(
        {
            "doc": F.coalesce("_json", "_second", F.parse_json(F.lit("{}"))),
            "decode_path": F.when(F.col("_json").isNotNull(), "json")
            .when(F.col("_second").isNotNull(), F.col("_retried.path"))
            .otherwise("failed"),
        }
    ).drop("_json", "_retried", "_second")


# --- schema profile -----------------------------------------------------------


def _variant_kind(v: str) -> str:
    """SQL text: ``OBJECT`` or ``LIST`` for containers, else the scalar type."""
    return (
        f"CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN 'VOID' "
        f"WHEN {_AS_OBJECT.format(v=v)} IS NOT NULL THEN 'OBJECT' "
        f"WHEN {_AS_LIST.format(v=v)} IS NOT NULL THEN 'LIST' ELSE schema_of_variant({v}) END"
    )


# Python type name of a kind
_TYPE_NAME = (
    "CASE {kind} WHEN 'VOID' THEN 'NoneType' WHEN 'OBJECT' THEN 'dict' WHEN 'LIST' THEN 'list' "
    "WHEN 'STRING' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'BIGINT' THEN 'int' ELSE 'float' END"
)


def schema_profile(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, path, type, n)``: how often each object member has which type.

    Lists are not looked into.  Types carry Python's names.  ``by`` profiles each
    value of some columns for itself.
    """
    own = [f"_by{i}" for i in range(len(by))]
    opened = _nodes(
        df.select(_as_variant(df, col).alias("_doc"), *[F.col(c).alias(o) for c, o in zip(by, own)]),
        F.col("_doc"),
        into_lists=False,
        keep_objects=True,
    )
    members = opened.select(*own, F.inline_outer("_nodes")).filter(F.size("path") > 0)
    return (
        members.select(*own, F.array_join("path", ".").alias("path"), F.expr(_variant_kind("value")).alias("kind"))
        .select(*own, "path", F.expr(_TYPE_NAME.format(kind="kind")).alias("type"))
        .groupBy(*own, "path", "type")
        .agg(F.count("*").alias("n"))
        .select(*[F.col(o).alias(c) for c, o in zip(by, own)], "path", "type", "n")
    )


def extract_schema(df: DataFrame, col: str, name: str) -> DataFrame:
    """Add ``schema``: per document ``{"name", "fields": [{"name", "type", "fields"?}]}`` as JSON text.

    Members are listed in key order; a document without members has no fields.
    """
    opened = _nodes(df, _as_variant(df, col), into_lists=False, keep_objects=True)
    # The nodes come parents first, so one pass can write the nested text: the
    # depth of the following node tells whether fields open, go on or close.
    members = opened.withColumn(
        "_members",
        F.expr(
            "transform(filter(_nodes, n -> size(n.path) > 0), n -> named_struct("
            "'depth', size(n.path), 'type', "
            + _TYPE_NAME.format(kind=_variant_kind("n.value"))
            + ", 'label', to_json(named_struct('name', element_at(n.path, -1)))))"
        ),
    )
    following = "coalesce(get(_members, i + 1).depth, 1)"
    text = (
        "concat(substring(m.label, 1, length(m.label) - 1), ',\"type\":\"', m.type, '\"', "
        f"CASE WHEN {following} > m.depth THEN ',\"fields\":[' "
        f"ELSE concat(CASE WHEN m.type = 'dict' THEN ',\"fields\":[]}}' ELSE '}}' END, "
        f"repeat(']}}', m.depth - {following}), "
        "CASE WHEN i + 1 < size(_members) THEN ',' ELSE '' END) END)"
    )
    head = F.to_json(F.struct(F.lit(name).alias("name")))
    schema = F.concat(
        F.expr("substring(_head, 1, length(_head) - 1)"),
        F.lit(',"fields":['),
        F.array_join(F.expr(f"transform(_members, (m, i) -> {text})"), ""),
        F.lit("]}"),
    )
    return members.withColumn("_head", head).select(*df.columns, schema.alias("schema"))


def merged_schema(df: DataFrame, col: str) -> DataFrame:
    """One row ``schema``: the type that covers every document of the column."""
    return df.agg(F.expr(f"schema_of_variant_agg({_column_sql(df, col)})").alias("schema"))


def _column_sql(df: DataFrame, col: str) -> str:
    quoted = f"`{col}`"
    return quoted if isinstance(df.schema[col].dataType, T.VariantType) else f"try_parse_json({quoted})"


# --- encoding -----------------------------------------------------------------


def _json_ready(c: Column, dtype: T.DataType) -> Column:
    """The value as it is to be written, at any depth of structs, lists and maps."""
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # JSON has no such numbers
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # the fraction is written only where there is one
        fraction = F.date_format(c, ".SSSSSS")
        zone = F.date_format(c, "xxx") if isinstance(dtype, T.TimestampType) else F.lit("")
        return F.concat(
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
            F.when(fraction == ".000000", "").otherwise(fraction),
            zone,
        )
    if isinstance(dtype, T.StructType):
        fields = [_json_ready(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _json_ready(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, v: _json_ready(v, dtype.valueType))
    return c


def row_json(df: DataFrame, cols: Sequence[str] | None = None, keep_nulls: bool = False) -> Column:
    """JSON text of a row.  Dates and times are ISO text, decimals are numbers, NaN and
    infinities are null; values inside structs, lists and maps are written like others.

    Null fields are left out unless ``keep_nulls``.
    """
    chosen = df.columns if cols is None else list(cols)
    row = F.struct(*[_json_ready(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in chosen])
    return F.to_json(
        row,
        {
            "ignoreNullFields": str(not keep_nulls).lower(),
            "dateFormat": "yyyy-MM-dd",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        },
    )


def rows_to_json(df: DataFrame, cols: Sequence[str] | None = None, keep_nulls: bool = False) -> DataFrame:
    """One column ``value``: each row as a JSON line."""
    return df.select(row_json(df, cols, keep_nulls).alias("value"))


# --- members of objects -------------------------------------------------------


def object_members(df: DataFrame, col: str, id_cols: Sequence[str]) -> DataFrame:
    """``(*id_cols, path ARRAY<STRING>, value STRING)``: the innermost members of objects.

    Lists stay whole; an empty object is a member with the value ``{}``.
    """
    opened = _nodes(df, F.col(col), into_lists=False, keep_objects=True)
    inner = F.expr(
        "filter(transform(filter(_nodes, n -> size(n.path) > 0), "
        "n -> named_struct('path', n.path, 'value', to_json(n.value))), "
        "m -> m.value = '{}' OR NOT startswith(m.value, '{'))"
    )
    members = opened.withColumn("_members", inner).select(*id_cols, F.inline_outer("_members"))
    return members.filter(F.col("path").isNotNull())
