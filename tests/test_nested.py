import json

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from roadlog.operators import nested, search

EXAMPLE = '{"a":1,"b":{"c":"x","d":[1,{"e":2}],"f":[1,2]},"g":{},"h":[],"n":null,"z":[[{"q":1}]]}'
FLAT = {"a": 1, "b.c": "x", "b.d.0": 1, "b.d.1.e": 2, "b.f": [1, 2], "h": [], "n": None, "z": [[{"q": 1}]]}


def texts(spark, *docs):
    return spark.createDataFrame(list(enumerate(docs)), "n int, doc string")


def flat(spark, *docs, **options):
    got = nested.flatten_json(texts(spark, *docs), "doc", ["n"], **options)
    out = {}
    for r in got.select("n", "path", F.to_json("value").alias("value")).collect():
        out.setdefault(r.n, []).append((r.path, json.loads(r.value)))
    return out


def test_example(spark):
    assert dict(flat(spark, EXAMPLE)[0]) == FLAT


def test_scalars_lists_and_nothing(spark):
    got = flat(spark, "5", '"t"', "[1,2]", "{}", "{bad", '[{"a":1},2]', "null")
    assert got == {0: [("", 5)], 1: [("", "t")], 2: [("", [1, 2])], 5: [("0.a", 1), ("1", 2)], 6: [("", None)]}


def test_clash_keeps_one(spark):
    assert flat(spark, '{"a":{"b":2},"a.b":1}') == {0: [("a.b", 1)]}


def test_any_depth(spark):
    doc, path = 7, []
    for level in range(60):
        doc = {f"k{level}": doc, "t": 'a "{[" text'} if level % 2 else {f"k{level}": [doc, {"x": level}]}
    got = dict(flat(spark, json.dumps(doc), '{"a":1}')[0])
    assert got == dict(leaves(doc)) and len(got) > 60


def test_deep_documents_are_not_copied_level_by_level(spark):
    """Of every node there is one lookup in the whole document; odd names go the other way."""
    deep = '{"k":' * 30 + '[1,{"b":1.50,"a":null,"e":{}},[2]]' + "}" * 30
    wide = '{"z":1,"x y":{"q":"{["},"é":[],"k":' + deep + "}"
    odd = '{"it\'s":' + deep + ',"k":{"":1}}'
    clash = '{"k.k":1,"k":{"k":2,"l":' + deep + "}}"
    docs = [deep, wide, odd, clash, "{" + deep, None]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, d string")
    at = ".".join(["k"] * 30)
    leaves = {(f"{at}.0", "1"), (f"{at}.1.a", "null"), (f"{at}.1.b", "1.5"), (f"{at}.2", "[2]")}
    beside = {("z", "1"), ("x y.q", '"{["'), ("é", "[]")}
    expected = {
        0: leaves,
        1: beside | {(f"k.{p}", v) for p, v in leaves},
        2: {(f"it's.{p}", v) for p, v in leaves} | {("k.", "1")},
        3: {("k.k", "1")} | {(f"k.l.{p}", v) for p, v in leaves},
    }
    for col in ("d", "v"):
        got = {}
        flat = nested.flatten_json(df.withColumn("v", F.try_parse_json("d")), col, ["i"])
        for r in flat.select("i", "path", F.to_json("value").alias("t")).collect():
            got.setdefault(r.i, set()).add((r.path, r.t))
        assert {k: v for k, v in got.items() if k != 3} == {k: v for k, v in expected.items() if k != 3}
        assert got[3] - {("k.k", "1"), ("k.k", "2")} == expected[3] - {("k.k", "1")}
    assert nested._node_paths(deep, True, False) is not None and nested._node_paths(odd, True, False) is None
    assert nested._node_paths('{"a":{"b":[{"c":1}]}}', True, False) is None


def test_many_clashes(spark):
    doc = {"a": {str(i): {"b": i} for i in range(300)}, **{f"a.{i}.b": -i for i in range(0, 300, 3)}}
    got = dict(flat(spark, json.dumps(doc))[0])
    assert len(got) == 300 and set(got) == {f"a.{i}.b" for i in range(300)}


def leaves(value, at=()):
    """What flattening should give, from the rules as stated."""
    if isinstance(value, dict):
        members = list(value.items())
    elif isinstance(value, list) and any(isinstance(v, dict) for v in value):
        members = [(str(i), v) for i, v in enumerate(value)]
    else:
        return [(".".join(at), value)]
    return [leaf for k, v in members for leaf in leaves(v, (*at, k))]


scalars = st.none() | st.booleans() | st.integers(-1000, 1000) | st.text("xyz", max_size=3)
documents = st.recursive(
    scalars,
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("abc", min_size=1, max_size=2), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(documents, min_size=20, max_size=20))
def test_flatten_property(spark, docs):
    got = flat(spark, *[json.dumps(d) for d in docs])
    for n, d in enumerate(docs):
        pairs = got.get(n, [])
        assert len({p for p, _ in pairs}) == len(pairs)
        assert dict(pairs) == dict(leaves(d))


def test_wide_and_struct(spark):
    (row,) = rows(nested.flatten_wide(texts(spark, EXAMPLE), "doc", ["a", "b.c", "b.f", "n", "none"]).drop("doc"))
    # the wanted path "n" replaces nothing: it is a column of the documents too
    assert (row["a"], row["b.c"], row["b.f"], row["none"]) == ("1", "x", "[1,2]", None)
    df = spark.createDataFrame([((1, ("x",)), [1])], "a struct<b int, c struct<d string>>, e array<int>")
    assert nested.flatten_struct(df).columns == ["a.b", "a.c.d", "e"]


def test_tolerant(spark):
    got = nested.decode_tolerant(texts(spark, '{"a":1}', "{'a': True, 'b': None}", "{oops", "(1, 2)", None, '{"a":NaN}'), "doc")
    out = [(r.decode_path, r.j) for r in got.orderBy("n").select("decode_path", F.to_json("doc").alias("j")).collect()]
    assert out == [
        ("json", '{"a":1}'),
        ("literal", '{"a":true,"b":null}'),
        ("failed", "{}"),
        ("literal", "[1,2]"),
        ("failed", "{}"),
        ("json", '{"a":"NaN"}'),
    ]


def test_profile(spark):
    got = nested.schema_profile(texts(spark, EXAMPLE, '{"a":1.5,"b":{"c":true}}', "[1]"), "doc")
    profile = {(r["path"], r["type"]): r["n"] for r in rows(got)}
    assert profile == {
        ("a", "int"): 1, ("a", "float"): 1, ("b", "dict"): 2, ("b.c", "str"): 1, ("b.c", "bool"): 1,
        ("b.d", "list"): 1, ("b.f", "list"): 1, ("g", "dict"): 1, ("h", "list"): 1, ("n", "NoneType"): 1,
        ("z", "list"): 1,
    }


def test_extract_schema(spark):
    docs = texts(spark, '{"a":{"b":{"c":1},"d":"x"},"e":{},"f":1.5}', "{}", '{"q\\"":null}')
    got = [json.loads(r.schema) for r in nested.extract_schema(docs, "doc", "car").orderBy("n").collect()]
    inner = [{"name": "b", "type": "dict", "fields": [{"name": "c", "type": "int"}]}, {"name": "d", "type": "str"}]
    assert got[0] == {
        "name": "car",
        "fields": [
            {"name": "a", "type": "dict", "fields": inner},
            {"name": "e", "type": "dict", "fields": []},
            {"name": "f", "type": "float"},
        ],
    }
    assert got[1] == {"name": "car", "fields": []}
    assert got[2] == {"name": "car", "fields": [{"name": 'q"', "type": "NoneType"}]}


def test_merged_schema(spark):
    (row,) = rows(nested.merged_schema(texts(spark, '{"a":1}', '{"b":"x"}'), "doc"))
    assert row["schema"] == "OBJECT<a: BIGINT, b: STRING>"


def test_rows_to_json(spark):
    df = spark.sql(
        "select 1 as i, 1.50BD as dec, date'2021-08-06' as d, timestamp_ntz'2021-08-06 07:00:00' as t, "
        "cast(null as string) as s, array(1,2) as l, 'é/\"' as u"
    )
    (row,) = rows(nested.rows_to_json(df))
    assert json.loads(row["value"]) == {
        "i": 1, "dec": 1.5, "d": "2021-08-06", "t": "2021-08-06T07:00:00", "l": [1, 2], "u": 'é/"',
    }
    assert "é" in row["value"]
    (row,) = rows(nested.rows_to_json(df, ["s"], keep_nulls=True))
    assert row["value"] == '{"s":null}'


def test_field_caps(spark):
    a = search.observed_fields(texts(spark, '{"x":1,"y":"s"}'), "doc", "one")
    b = search.observed_fields(texts(spark, '{"x":"t","y":"s"}'), "doc", "two")
    got = {(r["field"], r["type"]): r["indices"] for r in rows(search.field_caps(a, b))}
    assert got == {("x", "int"): ["one"], ("x", "str"): ["two"], ("y", "str"): ["one", "two"]}
    declared = search.declared_fields(texts(spark, "1"), "t")
    assert {(r["field"], r["type"]) for r in rows(declared)} == {("n", "int"), ("doc", "string")}


def test_documents_are_opened_once(spark):
    plan = nested.flatten_json(texts(spark, EXAMPLE), "doc", ["n"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson") == 1 and "Exchange" not in text


def test_values_are_written_alike_at_any_depth(spark):
    value = "1.50bd as d, timestamp'2021-08-06 07:00:00' as t, timestamp_ntz'2021-08-06 07:00:00.25' as n, double('NaN') as x"
    df = spark.sql(
        f"select {value}, named_struct('in', struct({value})) as s, array(struct({value}), null) as l, "
        f"map('k', struct({value})) as m, float('inf') as i, cast(null as struct<a: int>) as none"
    )
    flat_values = {"d": 1.5, "t": "2021-08-06T07:00:00+00:00", "n": "2021-08-06T07:00:00.250000"}
    got = json.loads(df.select(nested.row_json(df).alias("v")).first().v)
    assert got == {
        **flat_values, "s": {"in": flat_values}, "l": [flat_values, None], "m": {"k": flat_values},
    }
