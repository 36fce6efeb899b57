"""Versioned writes against a plain loop over the actions."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadlog.operators import documents, versioned

ACTION = (
    "seq long, op string, _index string, _id string, source string, if_seq_no long, if_primary_term long, "
    "version long, version_type string, retry_on_conflict long"
)
DOCUMENT = "_index string, _id string, source string, _version long, _seq_no long, _primary_term long"


def is_object(text):
    try:
        return isinstance(json.loads(text), dict)
    except (TypeError, ValueError):
        return False


def usable(a):
    _, op, _, name, source, seq_no, term, version, kind, retries = a
    if op not in ("index", "create", "update", "delete") or op != "delete" and not is_object(source):
        return False
    if op == "update" and not isinstance(json.loads(source).get("doc"), dict):
        return False
    if op in ("update", "delete") and name is None:
        return False
    conditions = (seq_no is not None) + (term is not None)
    if conditions:
        return conditions == 2 and version is None and op != "create" and name is not None and not (op == "update" and retries)
    if version is not None:
        return kind in ("external", "external_gte") and op in ("index", "delete") and name is not None and version >= 0
    return kind in (None, "internal")


def brute(docs, actions, term=1):
    """The table and the results after a loop."""
    state = {(i, n): [json.loads(s), v, q, t] for i, n, s, v, q, t in docs}
    gone = {}
    first = max([q for *_, q, _ in docs], default=-1) + 1
    results = []
    for place, a in enumerate(sorted(actions)):
        seq, op, index, name, source, seq_no, own_term, version, kind, _ = a
        key = (index or "", name)
        doc = state.get(key)
        now = doc[1] if doc else gone.get(key, -1)
        last = doc[2:] if doc else None
        status = None
        if not usable(a):
            status = 400
        elif seq_no is not None:
            status = 409 if last != [seq_no, own_term] else None
        elif version is not None:
            status = None if version > now or kind == "external_gte" and version == now else 409
        elif op == "create" and doc:
            status = 409
        elif op in ("update", "delete") and not doc:
            status = 404
        if status is None:
            status = 200 if doc else 404 if op == "delete" else 201
            after = version if version is not None else max(now, 0) + 1
            if op == "delete":
                state.pop(key, None)
                gone[key] = after
            elif op == "update":
                state[key] = [doc[0] | json.loads(source)["doc"], after, first + place, term]
            else:
                state[key] = [json.loads(source), after, first + place, term]
        results.append((seq, index or "", name, status))
    return {k: (v[0], *v[1:]) for k, v in state.items()}, sorted(results)


def applied(spark, docs, actions, **options):
    target = spark.createDataFrame(docs, DOCUMENT)
    got = versioned.apply_versioned(target, spark.createDataFrame(actions, ACTION), **options)
    table = {
        (r["_index"], r["_id"]): (json.loads(r["source"]), r["_version"], r["_seq_no"], r["_primary_term"])
        for r in rows(got.table)
    }
    return table, sorted((r["seq"], r["_index"], r["_id"], r["status"]) for r in rows(got.results))


def random_actions(rnd, n, names, kinds, first):
    out = []
    for seq in range(n):
        op = rnd.choice(["index", "index", "update", "update", "delete", "create"])
        index, name = rnd.choice(["a", None]), rnd.choice(names)
        seq_no = term = version = kind = retries = None
        roll = rnd.choice(kinds)
        if roll == "expects" and op != "create":
            # what may well have been the last write
            seq_no, term = max(0, first + seq - rnd.randint(1, 2 * len(names) + 3)), 1
            if rnd.random() < 0.1:
                seq_no, term = rnd.randint(0, first - 1), rnd.choice([1, 2])
        elif roll == "external" and op in ("index", "delete"):
            version, kind = rnd.randint(0, 12) + seq // 12, rnd.choice(["external", "external_gte"])
        elif roll == "wrong":
            seq_no, version, kind, retries = rnd.choice(
                [(3, None, None, None), (None, 3, None, None), (None, 3, "odd", None), (None, None, "external", None), (None, None, None, 2)]
            )
        source = json.dumps({"doc": {f"u{seq % 3}": seq}} if op == "update" else {"v": seq})
        out.append((seq, op, index, name, None if op == "delete" else source, seq_no, term, version, kind, retries))
    return out


@pytest.mark.parametrize(
    "kinds, bits", [(["free", "expects"], 2), (["external"], 3), (["free", "external"], 2), (["free", "expects", "external", "wrong"], 16)]
)
def test_random_actions(spark, kinds, bits):
    rnd = random.Random(f"{kinds}{bits}")
    names = [f"d{i}" for i in range(5)]
    docs = [("a" if i % 2 else "", n, '{"old":1}', 1 + i, 10 + i, 1 + i % 2) for i, n in enumerate(names) if i < 4]
    actions = random_actions(rnd, 160, names, kinds, 14)
    assert applied(spark, docs, actions, block_bits=bits) == brute(docs, actions)


def test_hot_document_in_many_blocks(spark):
    rnd = random.Random(1)
    docs = [("", "hot", "{}", 3, 7, 1)]
    actions = random_actions(rnd, 900, ["hot"], ["free", "expects", "expects"], 8)
    table, results = applied(spark, docs, actions, block_bits=4)
    assert (table, results) == brute(docs, actions)
    assert len({r[3] for r in results}) >= 3


def test_short_documents_are_not_cut_into_blocks(spark, monkeypatch):
    """A block a document and part of the order would be a row for nearly every action."""
    rnd = random.Random(3)
    names = [f"d{i}" for i in range(60)]
    docs = [("a" if i % 2 else "", n, '{"old":1}', 1 + i, 10 + i, 1 + i % 2) for i, n in enumerate(names) if i < 40]
    actions = random_actions(rnd, 300, names, ["free", "expects", "external", "wrong"], 50)
    # one document has more actions than a block has places
    actions += [(300 + i, "update", "a", "d1", '{"doc":{"n":%d}}' % i, None, None, None, None, None) for i in range(40)]
    cut = []
    blocks = versioned._blocks

    def counted(coded, *more):
        cut.append({tuple(r) for r in coded.select("_index", "_id").distinct().collect()})
        return blocks(coded, *more)

    monkeypatch.setattr(versioned, "_blocks", counted)
    assert applied(spark, docs, actions, block_bits=5) == brute(docs, actions)
    assert cut == [{("a", "d1")}]
    assert applied(spark, docs, actions) == brute(docs, actions)
    assert len(cut) == 1


def test_actions_are_made_once(spark):
    """Finding their places goes through the order twice, but not through what makes the actions."""
    made = spark.sparkContext.accumulator(0)
    schema = "seq long, op string, _id string, source string"

    def counting(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    given = [(i, "index" if i % 3 else "delete", f"d{i % 7}", '{"v":%d}' % i) for i in range(200)]
    actions = spark.createDataFrame(given, schema).mapInPandas(counting, schema)
    target = spark.createDataFrame([("d0", "{}"), ("z", "{}")], "_id string, source string")
    got = versioned.apply_versioned(target, actions)
    assert len(rows(got.results)) == 200
    assert {r["_id"]: json.loads(r["source"]) for r in rows(got.table)} == {"z": {}} | {
        f"d{i % 7}": {"v": i} for i in range(193, 200) if i % 3
    }
    assert made.value == 200


def test_blocks_are_folded_by_their_summaries():
    """A block says what it does to any state, as a loop over its actions does."""
    rnd = random.Random(9)
    for kinds in ([0], [0, 1], [2, 3]):
        for _ in range(300):
            actions = [
                versioned.Action(p, rnd.randint(0, 4), rnd.choice(kinds), rnd.randint(0, 12), rnd.choice([1, 1, 2]))
                for p in range(rnd.randint(1, 9))
            ]
            actions = [a._replace(op=0) if a.op == 1 and a.condition else a for a in actions]
            does = json.loads(json.dumps(versioned._summary(actions, 5, 1)))
            for state in [versioned._NEVER, (0, 3, 1, 1), (1, 2, 3, 1), (1, 9, 4, 2), (1, 12, 0, 1)]:
                now = state
                for a in actions:
                    _, now = versioned._step(now, a, 5, 1)
                assert versioned._after(state, does, 1) == now


def test_conditions_of_action_lines(spark):
    given = spark.createDataFrame(
        [(1, "index", "x", 4, 1, None, None, '{"v":1}'), (2, "delete", "y", None, None, 9, "external", None)],
        "seq long, _op_type string, _id string, _if_seq_no long, if_primary_term long, _version long, version_type string, _source string",
    )
    got = rows(versioned.with_conditions(documents.expand_actions(given)), "seq")
    assert [(r["op"], r["_id"], r["if_seq_no"], r["if_primary_term"], r["version"], r["version_type"]) for r in got] == [
        ("index", "x", 4, 1, None, None),
        ("delete", "y", None, None, 9, "external"),
    ]


def test_without_versions_and_empty(spark):
    target = spark.createDataFrame([("k", '{"a":1}'), ("z", "{}")], "_id string, source string")
    actions = spark.createDataFrame(
        [(1, "update", "k", '{"doc":{"b":2}}'), (2, "index", None, "{}"), (3, "delete", "nobody", None)],
        "seq long, op string, _id string, source string",
    )
    got = versioned.apply_versioned(target, actions, id_prefix="own")
    table = {r["_id"]: (json.loads(r["source"]), r["_version"], r["_seq_no"]) for r in rows(got.table)}
    assert table == {"k": ({"a": 1, "b": 2}, 2, 0), "z": ({}, 1, -1), "own-1": ({}, 1, 1)}
    assert [(r["status"], r["error"]) for r in rows(got.results, "seq")] == [
        (200, None), (201, None), (404, "document_missing_exception")
    ]
    same = versioned.apply_versioned(target, actions.limit(0))
    assert same.table.count() == 2 and same.results.count() == 0
    none = versioned.apply_versioned(target.limit(0), actions.filter(F.col("seq") == 2))
    assert none.table.count() == 1
