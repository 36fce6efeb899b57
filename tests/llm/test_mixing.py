import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm.helpers import AWKWARD, awkward, found, no_docs
from oracle import compare, connect
from pyspark.sql import functions as F

from roadlog.llm import mixing
from roadlog.llm.queries import QUERIES, SQL, mix_levels


def filled(children, budget):
    """``name -> tokens`` of ``name -> (weight, most)`` by raising a level until it is spent."""
    budget = min(budget, sum(m for _, m in children.values()))
    full = set()
    while True:
        left = budget - sum(children[n][1] for n in full)
        weight = sum(w for n, (w, _) in children.items() if n not in full)
        more = {n for n, (w, m) in children.items() if n not in full and Fraction(w * left, weight) >= m}
        if not more:
            break
        full |= more
        if len(full) == len(children):
            break
    return {
        n: m if n in full else (w * left) // weight for n, (w, m) in children.items()
    }


def brute(rows, weights, budget, epochs, seed, text=None):
    """Copies of ``(id, path, tokens)``; ``weights(path)`` is the weight of a node, ``text``
    has the text of an id."""
    held = defaultdict(int)
    for _, path, n in rows:
        for depth in range(len(path) + 1):
            held[path[:depth]] += n
    given = {(): min(budget, held[()] * epochs)}
    for depth in range(len(rows[0][1])):
        for parent in [p for p in given if len(p) == depth]:
            children = {p: (weights(p), held[p] * epochs) for p in held if len(p) == depth + 1 and p[:depth] == parent}
            given.update(filled(children, given[parent]))
    out = []
    for leaf in {p for _, p, _ in rows}:
        own = [(i, n) for i, p, n in rows if p == leaf]
        total = sum(n for _, n in own)
        passes, prefix = divmod(given[leaf], total) if total else (0, 0)

        def place(x):
            shown = "" if x[0] is None else x[0]
            key = hashlib.md5(((text or {}).get(x[0]) or "").encode()).hexdigest()
            return hashlib.md5(f"{seed}/{passes}/{shown}/{key}".encode()).hexdigest(), x[1]

        upto = 0
        for x in sorted(own, key=place):
            upto += x[1]
            out.append((x[0], leaf, x[1], passes + (0 < prefix and upto <= prefix)))
    return sorted(out, key=repr)


def levels():
    return [
        mixing.Level("a", F.col("a"), F.when(F.col("a") == "a0", 5).otherwise(1)),
        mixing.Level("b", F.col("b"), F.lit(3)),
        mixing.Level("c", F.col("c"), F.when(F.col("c") == "c1", 2).otherwise(1)),
    ]


def weight(path):
    return [None, 5 if path[0] == "a0" else 1, 3, 2 if path[-1] == "c1" else 1][len(path)]


@pytest.mark.parametrize("share, epochs", [((1, 2), 1), ((9, 10), 2), ((1, 20), 3), ((3, 1), 2), ((1, 1), 1)])
def test_against_brute_force(spark, monkeypatch, share, epochs):
    monkeypatch.setattr(mixing, "BLOCK", 3)
    rnd = random.Random(epochs)
    rows = [
        (i, (f"a{rnd.choice([0, 0, 0, 1, 2])}", f"b{rnd.randint(0, 2)}", f"c{rnd.randint(0, 3)}"), rnd.choice([0, 1, 5, 40]))
        for i in range(400)
    ]
    docs = spark.createDataFrame([(i, *p, n) for i, p, n in rows], "doc_id long, a string, b string, c string, n long")
    got = found(mixing.mix(docs, levels(), share, epochs, tokens=F.col("n")))
    assert max(r["copies"] for r in got) <= epochs
    total = sum(n for *_, n in rows)
    expected = brute(rows, weight, total * share[0] // share[1], epochs, 7)
    assert sorted(((r["doc_id"], (r["a"], r["b"], r["c"]), r["tokens"], r["copies"]) for r in got), key=repr) == expected


def test_shortage_goes_to_siblings_first(spark):
    nodes = spark.createDataFrame(
        [("p", "x", 1, 10, 100), ("p", "y", 1, 500, 100), ("p", "z", 2, 500, 100), ("q", "x", 1, 5, 100)],
        "p string, n string, weight long, most long, budget long",
    )
    got = {(r["p"], r["n"]): r["given"] for r in found(mixing.deal(nodes, ["p"], "n"))}
    assert got == {("p", "x"): 10, ("p", "y"): 30, ("p", "z"): 60, ("q", "x"): 5}


def test_same_as_sql(spark, small):
    assert compare(QUERIES["op9_mixing"](spark, small), connect(small), SQL["op9_mixing"]) is None


def test_documents_come_as_often_as_said(spark, awkward, no_docs):
    mixed = mixing.mix(awkward, mix_levels())
    rows = found(mixed)
    assert len(rows) == len(AWKWARD)
    assert sum(r["tokens"] for r in rows if r["doc_id"] == 7) == 40_000
    out = mixing.mixed_documents(awkward, mixed)
    assert out.columns == awkward.columns
    expected = Counter()
    for r in rows:
        expected[r["doc_id"], r["text_key"]] += r["copies"]
    named = Counter((r["doc_id"], hashlib.md5((r["text"] or "").encode()).hexdigest()) for r in found(out))
    assert named == +expected
    assert mixing.mix(no_docs, mix_levels()).count() == 0
    assert mixing.mixed_documents(no_docs, mixing.mix(no_docs, mix_levels())).count() == 0


@pytest.mark.parametrize("same_text", [False, True])
@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_without_or_with_one_id(spark, monkeypatch, doc_id, same_text):
    """A prefix ends among them as among any others."""
    monkeypatch.setattr(mixing, "BLOCK", 20)
    rows = [(doc_id, "one two three four" if same_text else f"one two three w{i}", "en", "src1", {"k": i}) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, more map<string,int>")
    mixed = mixing.mix(docs, mix_levels())
    copies = [r["copies"] for r in found(mixed)]
    assert sum(copies) == 150 and set(copies) == {0, 1}
    out = found(mixing.mixed_documents(docs, mixed))
    assert len(out) == 150 and len({r["more"]["k"] for r in out}) == 150
