import json
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from roadlog.operators import bulk, documents, keyed, ordered, search

# --- ids and lines ------------------------------------------------------------


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(1, 11, True, "x"), (11, 1, False, None)], "a int, b int, flag boolean, s string")


def ids(df):
    return sorted(r["_id"] for r in rows(df))


def test_separator_keeps_ids_apart(pairs):
    assert ids(documents.document_ids(pairs, ["a", "b"])) == ["11|1", "1|11"]
    assert ids(documents.document_ids(pairs, ["a", "b"], sep="")) == ["111", "111"]
    assert rows(documents.document_id_collisions(pairs, ["a", "b"])) == [{"_id": "111", "n_keys": 2}]
    assert rows(documents.document_id_collisions(pairs, ["a", "b"], sep="|")) == []


def test_separator_in_a_key_is_escaped(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), ("a\\|", "c")], "k string, l string")
    assert len(set(ids(documents.document_ids(df, ["k", "l"])))) == 4
    assert ids(documents.document_ids(df.limit(1), ["k", "l"])) == ["a\\|b|c"]


def test_boolean_and_missing_keys(pairs):
    assert ids(documents.document_ids(pairs, ["a", "flag"])) == ["11|False", "1|True"]
    assert ids(documents.document_ids(pairs, ["a", "s"], missing="empty")) == ["11|", "1|x"]
    unsure = documents.document_ids(pairs, ["a", "s"], missing="null")
    assert documents.without_id(unsure).count() == 1
    with pytest.raises(Exception, match="document without key s"):
        documents.document_ids(pairs, ["a", "s"]).collect()
    with pytest.raises(ValueError):
        documents.document_ids(pairs, ["a"], missing="maybe")


def test_removed_keys(pairs):
    got = {r["_id"]: json.loads(r["source"]) for r in rows(documents.document_ids(pairs, ["a", "b"], remove_keys=True))}
    assert got == {"1|11": {"flag": True, "s": "x"}, "11|1": {"flag": False}}
    assert rows(documents.document_ids(pairs.select("a"), ["a"], remove_keys=True))[0]["source"] == "{}"


def test_lines(pairs):
    one = pairs.filter("a = 1").select("a", "s")
    assert rows(documents.bulk_pairs(one, ["a"]))[0]["value"] == '{"index":{"_id":"1"}}\n{"a":1,"s":"x"}'
    two = documents.bulk_lines(one, ["a"], ["a"]).orderBy("a", "pos").collect()
    assert [r.line for r in two] == ['{"index":{"_id":"1"}}', '{"a":1,"s":"x"}']


# --- expansion ----------------------------------------------------------------


def expanded(df):
    return [
        (json.loads(r["action_line"]), None if r["source_line"] is None else json.loads(r["source_line"]))
        for r in rows(df, "seq")
    ]


def test_expand_columns(spark):
    schema = "seq long, _op_type string, _id string, _index string, _routing string, pipeline string, f int"
    df = spark.createDataFrame(
        [(1, None, "a", "i", "r", "p", 1), (2, "delete", "b", None, None, None, 2), (3, "create", None, None, None, None, 3)],
        schema,
    )
    assert expanded(documents.expand_actions(df)) == [
        ({"index": {"_id": "a", "_index": "i", "pipeline": "p", "routing": "r"}}, {"f": 1}),
        ({"delete": {"_id": "b"}}, None),
        ({"create": {}}, {"f": 3}),
    ]


def test_expand_source_column(spark):
    schema = "seq long, _op_type string, _id string, _source string, f int"
    df = spark.createDataFrame(
        [(1, "index", "a", '{"x":1}', 9), (2, "update", "b", "true", 9), (3, "update", "c", '{"doc":{}}', 9), (4, "index", "d", None, 9)],
        schema,
    )
    assert expanded(documents.expand_actions(df)) == [
        ({"index": {"_id": "a"}}, {"x": 1}),
        ({"update": {"_id": "b", "_source": True}}, {"f": 9}),
        ({"update": {"_id": "c"}}, {"doc": {}}),
        ({"index": {"_id": "d"}}, {"f": 9}),
    ]


def test_expand_struct_source(spark):
    df = spark.sql("select 1L as seq, 'a' as _id, named_struct('x', 1) as _source, 5 as f")
    assert expanded(documents.expand_actions(df)) == [({"index": {"_id": "a"}}, {"x": 1})]


def test_every_metadata_name(spark):
    columns = ", ".join(f"'{m}' as `{m}`" for m in documents.META_FIELDS if m not in ("_if_seq_no", "_version"))
    df = spark.sql(f"select 1L as seq, 2 as keep, {columns}")
    ((action, source),) = expanded(documents.expand_actions(df))
    assert source == {"keep": 2}
    assert {"_percolate", "_timestamp", "_type", "if_seq_no", "parent", "routing", "version_type"} <= set(action["index"])
    assert not {"_parent", "_routing", "_retry_on_conflict", "_version_type"} & set(action["index"])
    assert len(documents.META_FIELDS) == 20


def test_expand_json(spark):
    texts = [
        '{"_op_type":"update","_id":"1","_source":true,"doc":{"a":1}}',
        '{"_id":2,"_version":3,"z":null,"y":[1,{"q":"é"}]}',
        '{"_op_type":"delete","_id":"9","q":1}',
        '{"_index":"i","_source":{"k":1},"other":2}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, action string")
    assert expanded(documents.expand_json_actions(df, "action")) == [
        ({"update": {"_id": "1", "_source": True}}, {"doc": {"a": 1}}),
        ({"index": {"_id": 2, "version": 3}}, {"z": None, "y": [1, {"q": "é"}]}),
        ({"delete": {"_id": "9"}}, None),
        ({"index": {"_index": "i"}}, {"k": 1}),
    ]


def test_expand_raw(spark):
    df = spark.createDataFrame([(1, '{"a":1}')], "seq long, line string")
    assert expanded(documents.expand_raw(df, "line")) == [({"index": {}}, {"a": 1})]


# --- running values -----------------------------------------------------------


@pytest.mark.parametrize("bits, levels", [(0, 1), (3, 1), (3, 2), (4, 3), (20, 1)])
def test_last_before_and_rank(spark, bits, levels):
    rng = random.Random(bits)
    places = rng.sample(range(-500, 5000), 300)
    # one key owns most of the rows
    data = [(rng.choice("aaaab"), p, rng.choice([None, None, rng.randrange(9)])) for p in places]
    df = spark.createDataFrame(data, "k string, place long, v int")
    got = {
        r["place"]: (r["prior"], r["rank"], r["all"])
        for r in rows(
            ordered.rank_in_order(
                ordered.rank_in_order(
                    ordered.last_before(df, ["k"], "place", F.col("v"), "prior", bits, levels), "place", "rank", ["k"], bits, levels
                ),
                "place",
                "all",
            )
        )
    }
    prior, count = {}, {}
    for n, (k, p, v) in enumerate(sorted(data, key=lambda r: r[1])):
        assert got[p] == (prior.get(k), count.get(k, 0), n)
        count[k] = count.get(k, 0) + 1
        if v is not None:
            prior[k] = v


def test_positions_by_several_columns(spark):
    rng = random.Random(5)
    data = [(rng.choice([0, 0, 0, 1 << 40]), rng.randrange(3), i) for i in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "a long, b long, c long").repartition(5)
    got = sorted((r["place"], r["a"], r["b"], r["c"]) for r in rows(ordered.positions(df, ["a", "b", "c"])))
    assert got == [(n, *r) for n, r in enumerate(sorted(data))]
    assert rows(ordered.positions(df.limit(0), ["a"])) == []


# --- chunks -------------------------------------------------------------------


def greedy(sizes, size, limit):
    chunks = []
    for s in sizes:
        if not chunks or len(chunks[-1]) == size or sum(chunks[-1]) + s > limit:
            chunks.append([])
        chunks[-1].append(s)
    return chunks


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 8), st.integers(1, 120))
def test_chunk_bounds_property(sizes, size, limit):
    starts = bulk.chunk_bounds(np.array(sizes, dtype=int), size, limit)
    edges = [*starts, len(sizes)]
    assert [sizes[a:b] for a, b in zip(edges, edges[1:])] == greedy(sizes, size, limit)


def actions(spark, n, text=lambda i: "x" * (i % 37)):
    df = spark.createDataFrame([(i, str(i), text(i)) for i in range(n)], "seq long, _id string, t string")
    return documents.expand_actions(df)


def test_501_actions_make_two_chunks(spark):
    got = rows(bulk.chunk_actions(actions(spark, 501)).groupBy("lane", "chunk").agg(F.count("*").alias("n")), "chunk")
    assert [r["n"] for r in got] == [500, 1]


def test_oversized_action_is_alone(spark):
    acts = actions(spark, 5, lambda i: "é" * 100 if i == 2 else "x")
    sizes = {r["seq"]: r["bytes"] for r in rows(bulk.chunk_actions(acts))}
    # UTF-8 bytes, one line feed per line
    assert sizes[2] == len('{"index":{"_id":"2"}}') + 1 + len('{"t":""}') + 200 + 1
    chunks = [r["chunk"] for r in rows(bulk.chunk_actions(acts, max_bytes=100), "seq")]
    assert chunks == [0, 0, 1, 2, 2]


def test_chunks_across_arrow_batches(spark):
    acts = actions(spark, 3000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = rows(bulk.chunk_actions(acts, size=50, max_bytes=2000, lane_bits=10), "seq")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 3000
    lanes = {}
    for r in sorted(got, key=lambda r: r["seq"]):
        lanes.setdefault(r["lane"], {}).setdefault(r["chunk"], []).append(r["bytes"])
    assert sorted(lanes) == [0, 1, 2]
    for chunks in lanes.values():
        assert list(chunks) == list(range(len(chunks)))
        flat = [b for c in chunks.values() for b in c]
        assert list(chunks.values()) == greedy(flat, 50, 2000)


def test_count_chunks_equal_greedy_without_byte_limit(spark):
    acts = actions(spark, 1234)
    window = {r["seq"]: r["chunk"] for r in rows(bulk.chunk_by_count(acts, size=100).select("seq", "chunk"))}
    cut = {r["seq"]: r["chunk"] for r in rows(bulk.chunk_actions(acts, size=100, max_bytes=1 << 40))}
    assert window == cut


def test_payloads_are_the_chunks(spark):
    acts = documents.expand_actions(
        spark.createDataFrame(
            [(i, "delete" if i % 3 == 0 else "index", str(i), f"t{i}") for i in range(700)],
            "seq long, _op_type string, _id string, t string",
        )
    )
    got = rows(bulk.chunk_payloads(acts, size=40, max_bytes=1500), "lane", "chunk")
    lines = {r["seq"]: (r["action_line"], r["source_line"]) for r in rows(acts)}
    chunks = {}
    for r in rows(bulk.chunk_actions(acts, size=40, max_bytes=1500), "seq"):
        chunks.setdefault((r["lane"], r["chunk"]), []).append(r["seq"])
    expected = {
        k: "".join(line + "\n" for i in sorted(seqs) for line in lines[i] if line is not None) for k, seqs in chunks.items()
    }
    assert {(r["lane"], r["chunk"]): r["payload"] for r in got} == expected
    assert all(r["bytes"] == len(r["payload"]) <= 1500 and r["n"] <= 40 for r in got)
    assert rows(bulk.chunk_payloads(acts.limit(0))) == []


# --- keyed tables -------------------------------------------------------------


ACTIONS = "seq long, op string, _id string, source string"


def merge(doc, part):
    for k, v in part.items():
        if isinstance(v, dict):
            inner = doc[k] if isinstance(doc.get(k), dict) else {}
            doc[k] = merge(inner, v)
        else:
            doc[k] = v
    return doc


def replay(table, acts):
    """Apply the actions one by one."""
    docs, statuses = {k: json.loads(v) for k, v in table}, {}
    for seq, op, i, source in sorted(acts):
        there = i in docs
        if op == "index":
            statuses[seq] = 200 if there else 201
            docs[i] = json.loads(source)
        elif op == "create":
            statuses[seq] = 409 if there else 201
            if not there:
                docs[i] = json.loads(source)
        elif op == "delete":
            statuses[seq] = 200 if there else 404
            docs.pop(i, None)
        else:
            statuses[seq] = 200 if there else 404
            if there:
                merge(docs[i], json.loads(source)["doc"])
    return docs, statuses


def random_doc(rng, depth=0):
    doc = {}
    for k in rng.sample("abc", rng.randrange(1, 3)):
        roll = rng.random()
        if roll < 0.45 and depth < 3:
            doc[k] = random_doc(rng, depth + 1)
        elif roll < 0.55:
            doc[k] = {}
        elif roll < 0.65:
            doc[k] = [1, {"z": 2}]
        else:
            doc[k] = rng.choice([None, True, 1.5, 7, "t"])
    return doc


@pytest.mark.parametrize("seed", [1, 2])
def test_apply_equals_replay(spark, seed):
    rng = random.Random(seed)
    table = [(str(i), json.dumps(random_doc(rng))) for i in range(4)]
    acts = []
    for seq in rng.sample(range(4000), 700):
        # half of the actions hit one document
        doc_id = "0" if rng.random() < 0.5 else str(rng.randrange(40))
        op = rng.choices(["index", "create", "update", "delete"], [1, 2, 12, 1])[0]
        source = {"update": {"doc": random_doc(rng)}, "delete": None}.get(op, random_doc(rng))
        acts.append((seq, op, doc_id, None if source is None else json.dumps(source)))
    schema = "seq long, op string, _id string, source string"
    applied = keyed.apply_actions(
        spark.createDataFrame(table, "_id string, source string"), spark.createDataFrame(acts, schema), block_bits=5
    )
    docs, statuses = replay(table, acts)
    assert {r["seq"]: r["status"] for r in rows(applied.results)} == statuses
    assert {r["_id"]: json.loads(r["source"]) for r in rows(applied.table)} == docs


def apply(spark, table, acts):
    return keyed.apply_actions(
        spark.createDataFrame(table, "_id string, source string"),
        spark.createDataFrame(acts, "seq long, op string, _id string, source string"),
    )


def test_apply_cases(spark):
    got = apply(
        spark,
        [("a", '{"v":0}')],
        [
            (1, "create", "b", '{"v":1}'),
            (2, "create", "b", '{"v":2}'),
            (3, "update", "c", '{"doc":{"v":3}}'),
            (4, "delete", "a", None),
            (5, "index", "a", '{"v":5}'),
            (6, None, None, '{"v":6}'),
            (7, "update", "a", '{"v":7}'),
            (8, "explode", "a", "{}"),
        ],
    )
    assert {r["seq"]: (r["status"], r["error"]) for r in rows(got.results)} == {
        1: (201, None),
        2: (409, "version_conflict_engine_exception"),
        3: (404, "document_missing_exception"),
        4: (200, None),
        5: (201, None),
        6: (201, None),
        7: (400, "action_request_validation_exception"),
        8: (400, "action_request_validation_exception"),
    }
    docs = {r["_id"]: r["source"] for r in rows(got.table)}
    (own,) = set(docs) - {"a", "b"}
    assert len(own) == 36 and docs == {"a": '{"v":5}', "b": '{"v":1}', own: '{"v":6}'}
    assert {r["seq"] for r in rows(keyed.failures(got.results))} == {2, 3, 7, 8}
    with pytest.raises(Exception, match="action failed"):
        keyed.raise_on_failure(got.results).collect()


def test_replay_changes_nothing(spark):
    acts = [(1, "index", "a", '{"v":1}'), (2, "delete", "b", None), (3, "index", "c", '{"v":3}')]
    once = apply(spark, [("b", "{}")], acts).table
    again = apply(spark, [(r["_id"], r["source"]) for r in rows(once)], acts).table
    assert rows(once) == rows(again)


def test_fast_path_equals_fold(spark):
    rng = random.Random(3)
    acts = [(i, rng.choice(["index", "delete"]), str(rng.randrange(20)), f'{{"v":{i}}}') for i in range(200)]
    target = spark.createDataFrame([(str(i), "{}") for i in range(30)], "_id string, source string")
    df = spark.createDataFrame(acts, "seq long, op string, _id string, source string")
    assert rows(keyed.last_write_wins(target, df)) == rows(keyed.apply_actions(target, df).table)
    with pytest.raises(Exception, match="not an index or delete action"):
        keyed.last_write_wins(target, df.withColumn("op", F.lit("update"))).collect()


def test_awkward_actions_change_nothing_and_lose_nothing(spark):
    got = apply(
        spark,
        [("a", '{"v":1e2,"w":1.50,"x":12345678901234567890123}'), ("bad", None), ("list", "[1]")],
        [
            (1, "index", "a", None),
            (2, "index", "a", "[1]"),
            (3, "create", "b", "{oops"),
            (4, "update", "a", '{"doc":{"new":true}}'),
            (5, "update", None, '{"doc":{"new":true}}'),
            (6, "delete", None, None),
            (7, "index", None, '{"v":7}'),
            (8, "index", None, '{"v":8}'),
            (9, "update", "bad", '{"doc":{"k":1}}'),
            (10, "update", "list", '{"doc":{"k":2}}'),
            (11, "update", "b", '{"doc":{"k":2}}'),
            (12, "update", "a", '{"doc":[1]}'),
        ],
    )
    status = {r["seq"]: r["status"] for r in rows(got.results)}
    assert status == {1: 400, 2: 400, 3: 400, 4: 200, 5: 400, 6: 400, 7: 201, 8: 201, 9: 200, 10: 200, 11: 404, 12: 400}
    docs = {r["_id"]: r["source"] for r in rows(got.table)}
    assert len(docs) == 5
    # numbers that no update touches keep their spelling
    assert docs["a"] == '{"v":1e2,"w":1.50,"x":12345678901234567890123,"new":true}'
    assert docs["bad"] == '{"k":1}' and docs["list"] == '{"k":2}'


def test_made_up_ids_meet_no_document(spark):
    target = spark.createDataFrame([("own-1", '{"v":0}')], "_id string, source string")
    acts = spark.createDataFrame([(5, None, None, '{"v":5}'), (6, None, None, '{"v":6}')], ACTIONS)
    got = keyed.apply_actions(target, acts, id_prefix="own")
    assert {r["seq"]: r["status"] for r in rows(got.results)} == {5: 201, 6: 409}
    assert {r["_id"]: r["source"] for r in rows(got.table)} == {"own-1": '{"v":0}', "own-0": '{"v":5}'}
    # and two calls do not meet each other
    both = keyed.apply_actions(got.table, acts).table
    assert both.count() == 4


def test_indices_are_kept_apart(spark):
    target = spark.createDataFrame(
        [("A", "1", '{"v":"a"}'), ("B", "1", '{"v":"b"}'), (None, "1", '{"v":"none"}')],
        "_index string, _id string, source string",
    )
    acts = spark.createDataFrame(
        [(1, "update", "A", "1", '{"doc":{"w":1}}'), (2, "delete", None, "1", None), (3, "create", "C", "1", "{}")],
        "seq long, op string, _index string, _id string, source string",
    )
    got = keyed.apply_actions(target, acts)
    assert [r["status"] for r in rows(got.results, "seq")] == [200, 200, 201]
    docs = {(r["_index"], r["_id"]): r["source"] for r in rows(got.table)}
    assert docs == {("A", "1"): '{"v":"a","w":1}', ("B", "1"): '{"v":"b"}', ("C", "1"): "{}"}
    wins = keyed.last_write_wins(target, acts.withColumn("op", F.when(F.col("op") == "delete", "delete").otherwise("index")))
    assert {(r["_index"], r["_id"]) for r in rows(wins)} == {("A", "1"), ("B", "1"), ("C", "1")}


def test_order_by_several_columns(spark):
    acts = spark.createDataFrame(
        [(1 << 50, 0, "last"), (3, 1 << 40, "first"), (3, (1 << 40) + 1, "second")], "batch long, number long, v string"
    ).select("*", F.lit("index").alias("op"), F.lit("x").alias("_id"), F.to_json(F.struct("v")).alias("source"))
    target = spark.createDataFrame([], "_id string, source string")
    assert [r["source"] for r in rows(keyed.apply_actions(target, acts, ("batch", "number")).table)] == ['{"v":"last"}']


def test_apply_touches_what_the_actions_name(spark, tmp_path):
    """Documents that are not named are neither sorted nor shuffled with their sources."""
    spark.range(1000).selectExpr("cast(id as string) as _id", "'{}' as source").write.parquet(f"{tmp_path}/docs")
    target = spark.read.parquet(f"{tmp_path}/docs")
    acts = spark.createDataFrame([(1, "index", "5", '{"v":1}'), (2, "update", "7", '{"doc":{"v":2}}')], ACTIONS)
    out = keyed.apply_actions(target, acts).table
    plan = out._jdf.queryExecution().executedPlan().toString()
    untouched = plan[: plan.index("Union") + 2000].split("BroadcastHashJoin")[1]
    assert "LeftAnti" in untouched and out.count() == 1000
    anti = next(line for line in plan.splitlines() if "LeftAnti" in line)
    assert "BroadcastHashJoin" in anti
    # one list a document, of the members written after its last replacement
    logical = out._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("collect_list") == 1 and "_base" in logical


def test_only_last_writes_are_gathered(spark):
    """A member that is written over and over is one entry of the list."""
    acts = [(i, "update", "a", json.dumps({"doc": {"n": i, f"k{i % 3}": i}})) for i in range(400)]
    acts.insert(200, (1000, "index", "a", '{"fresh":1}'))
    acts = [(n, *a[1:]) for n, a in enumerate(acts)]
    got = apply(spark, [("a", "{}")], acts).table
    assert json.loads(rows(got)[0]["source"]) == {"fresh": 1, "n": 399, "k0": 399, "k1": 397, "k2": 398}


def test_writes_without_ids(spark):
    target = spark.createDataFrame([("a", "{}")], "_id string, source string")
    acts = spark.createDataFrame([(1, "index", None, '{"v":1}'), (2, "index", None, '{"v":2}')], ACTIONS)
    assert keyed.last_write_wins(target, acts).count() == 3
    with pytest.raises(Exception, match="a delete needs an id"):
        keyed.last_write_wins(target, acts.withColumn("op", F.lit("delete"))).collect()


def test_reindex_and_where(spark):
    src = spark.sql(
        "select * from values ('1', 'old', 5, named_struct('n', 1)), ('2', 'old', 9, named_struct('n', 2)), "
        "('3', 'old', null, named_struct('n', 3)) as t(_id, _index, v, fields)"
    )
    got = rows(keyed.reindex_documents(src, "v > 4", "new"), "_id")
    assert [(r["_id"], r["_index"], r["n"]) for r in got] == [("1", "new", 1), ("2", "new", 2)]
    assert keyed.reindex_documents(src, None, "new", max_docs=1).count() == 1
    docs = documents.document_ids(src.select("_id", "v"), ["_id"], remove_keys=True)
    moved = keyed.reindex(docs, spark.createDataFrame([("1", "{}"), ("9", "{}")], docs.schema), "_id <> '3'", "new")
    assert {r["_id"]: r["source"] for r in rows(moved.table)} == {"1": '{"v":5}', "2": '{"v":9}', "9": "{}"}
    assert rows(moved.tally) == [{"success": 2, "failed": 0}]
    target = spark.createDataFrame([("new", "1", "{}"), ("old", "1", "{}")], "_index string, _id string, source string")
    lifted = src.select("_id", "_index", "fields", F.lit("{}").alias("source"))
    into = rows(keyed.reindex(lifted, target, None, "new").table, "_index", "_id")
    assert [(r["_index"], r["_id"], r["n"]) for r in into] == [("new", "1", 1), ("new", "2", 2), ("new", "3", 3), ("old", "1", None)]
    assert ids(keyed.delete_where(src, "v > 5")) == ["1", "3"]
    assert ids(keyed.delete_where(src, "v > 1", max_docs=1, order=["v"])) == ["2", "3"]
    # a name has two columns: one row of "a" goes, none of "b", whose row does not match
    two = spark.sql("select * from values ('a', 1, 10), ('b', 1, 1), ('a', 2, 10), ('a', null, 10), (null, 1, 10) as t(_index, _id, v)")
    gone = lambda **o: sorted(((r["_index"], r["_id"]) for r in rows(keyed.delete_where(two, "v = 10", **o))), key=str)
    assert gone(max_docs=1) == [("a", 1), ("a", 2), ("a", None), ("b", 1)]
    assert gone(max_docs=2) == [("a", 1), ("a", 2), ("b", 1)]
    assert gone(max_docs=2, order=["_id:desc"]) == [("a", 1), ("a", None), ("b", 1)]
    assert gone(max_docs=9) == [("b", 1)] and len(gone(max_docs=0)) == 5
    capped = keyed.update_where(two, "v = 10", {"v": "v + _id", "w": F.lit(1)}, 2, ["_id"])
    assert capped.columns == ["_index", "_id", "v", "w"]
    assert sorted(((r["_index"], r["_id"], r["v"], r["w"]) for r in rows(capped)), key=str) == [
        ("a", 1, 11, 1), ("a", 2, 10, None), ("a", None, 10, None), ("b", 1, 1, None), (None, 1, 11, 1)
    ]
    assert rows(keyed.match_tally(two, "v = 10", 2)) == [{"total": 5, "matched": 2}]
    changed = keyed.update_where(src, "v > 5", {"v": "v + 1", "w": F.col("v")})
    assert [(r["v"], r["w"]) for r in rows(changed, "_id")] == [(5, None), (10, 9), (None, None)]
    assert rows(keyed.match_tally(src, "v > 5")) == [{"total": 3, "matched": 1}]


# --- search -------------------------------------------------------------------


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(str(i), i % 4 or None, f"n{i}") for i in range(20)], "_id string, v int, name string")


def test_lookup(spark, docs):
    got = rows(search.lookup(docs, ["3", "x", "3"]))
    assert sorted((r["_id"], r["found"], r["name"]) for r in got if r["found"]) == [("3", True, "n3")] * 2
    assert [r["name"] for r in got if not r["found"]] == [None]
    pairs = docs.withColumn("_index", F.when(F.col("v") == 1, "one").otherwise("other"))
    both = ["_index", "_id"]
    listed = rows(search.lookup(pairs, [("one", "1"), ("other", "1"), ("other", "2")], both), *both)
    assert [(r["_index"], r["_id"], r["found"]) for r in listed] == [("one", "1", True), ("other", "1", False), ("other", "2", True)]
    asked = spark.createDataFrame([("one", "1"), ("other", "1"), (None, "2")], "_index string, _id string")
    assert sorted(r["found"] for r in rows(search.exists_ids(pairs, asked, both))) == [False, False, True]
    assert search.existing_ids(pairs, asked, both).count() == 1 and search.missing_ids(pairs, asked, both).count() == 2
    wanted = spark.createDataFrame([("3",), ("x",), ("3",)], "_id string")
    assert rows(search.lookup(docs, wanted)) == got
    assert ids(search.existing_ids(docs, wanted)) == ["3", "3"] and ids(search.missing_ids(docs, wanted)) == ["x"]
    assert {r["_id"]: r["found"] for r in rows(search.exists_ids(docs, wanted))} == {"3": True, "x": False}


def test_pages(docs):
    page = search.search_page(docs, "v is not null", ["v:desc", "_id"], 2, 3, exclude=["name"])
    assert page.columns == ["_id", "v"]
    # ids are text: 11, 15, 19, 3, 7
    assert [r["_id"] for r in page.collect()] == ["19", "3", "7"]
    assert search.search_page(docs).count() == 10
    last = search.search_page(docs, sort=["v:asc", "_id"], size=20).collect()[-1]
    assert last["v"] is None
    with pytest.raises(ValueError):
        search.search_page(docs, sort=["v:up"])
    assert rows(search.match_count(docs, "v = 1")) == [{"count": 5}]
    assert [r["_id"] for r in search.scan_documents(docs, "v = 1", True, ["_id:desc"]).collect()] == ["9", "5", "17", "13", "1"]
    assert search.scan_documents(docs).count() == 20


def test_multi_search(docs):
    got = search.multi_search(
        docs, {"a": search.Search("v = 1", ["_id"], size=2, columns=["_id"]), "b": search.Search(size=3)}
    )
    assert sorted(r["search"] for r in rows(got)) == ["a", "a", "b", "b", "b"]
    assert got.columns == ["search", "_id", "v", "name"]
