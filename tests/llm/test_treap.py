import math
import random
import re
from collections import Counter

import numpy as np
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of

from roadlog.llm import treap
from roadlog.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items, k=20):
    docs = [(i, Counter(ts), len(ts)) for i, ts in ((i, terms_of(t)) for i, t in docs) if ts]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms_of(text))
        scored = []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        first = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(first, 1)]
    return sorted(out, key=repr)


def ask(spark, docs, items, k=20, block_docs=treap.BLOCK_DOCS, restricted=True):
    asked = treap.questions(spark.createDataFrame(items, "item_id long, text string"))
    index = treap.index(docs, asked.select("term").distinct() if restricted else None, block_docs)
    got = found(treap.search(index, asked, k))
    return sorted(((r["id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr)


def test_tree_holds_the_largest_impact_of_every_cell():
    rnd = np.random.default_rng(1)
    cells = rnd.choice(64 * 64, 500, replace=False)
    rows, columns, impacts = cells // 64, cells % 64, rnd.integers(1, 1000, 500)
    masks, tops = treap.tree_of(rows, columns, impacts, 6)
    assert len(tops) == 7 and tops[0].tolist() == [impacts.max()]
    for level in range(7):
        size = 64 >> level
        largest = {}
        for r, c, i in zip(rows, columns, impacts):
            # quarters in order: two bits a level, the row's before the column's
            path = sum(((r >> b & 1) << 1 | (c >> b & 1)) << 2 * b for b in range(6)) // (size * size)
            largest[path] = max(largest.get(path, 0), i)
        assert tops[level].tolist() == [largest[p] for p in sorted(largest)]
        if level < 6:
            assert sum(bin(m).count("1") for m in masks[level]) == len(tops[level + 1])


def test_against_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(80)] + ["É", "日本", "x1", "The"]
    text = lambda: "-".join(rnd.choices(words, [1 / (i + 1) for i in range(len(words))], k=rnd.randint(0, 60)))
    rows = [(i * 7 - 500, text()) for i in range(400)] + [(5000 + i, "w3 w40 rare") for i in range(300)]
    rnd.shuffle(rows)
    items = [(i, text()) for i in range(12)] + [(90, "rare w40 W40"), (91, ""), (92, None), (93, "unheard of"), (94, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute(rows, items)
    assert ask(spark, docs, items) == expected
    assert ask(spark, docs, items, block_docs=7) == expected
    assert ask(spark, docs, items, restricted=False) == expected
    assert ask(spark, docs, items, 3, 50) == brute(rows, items, 3)


def test_questions_in_several_parts(spark, monkeypatch):
    rows = [(i, f"a{i % 5} b{i % 7} c") for i in range(100)]
    items = [(i, f"a{i} b{i} c c") for i in range(7)]
    monkeypatch.setattr(treap, "PART_BYTES", 60)
    assert ask(spark, spark.createDataFrame(rows, "doc_id long, text string"), items) == brute(rows, items)


def test_copies_do_not_make_a_question_look_at_all_of_them(monkeypatch):
    builder = treap._Builder(5000, 15000)
    for i in range(5000):
        builder.add(5000 - i, 3, [(b"a", 1), (b"b", 2)] + [(b"c%d" % i, 1)] * (i >= 4000))
    grid = treap._Grid(dict(zip([c.split()[0] for c in treap._BLOCK.split(", ")], builder.block())))
    scored = []
    take = treap._Best.take
    monkeypatch.setattr(treap._Best, "take", lambda self, s, i, u: scored.append(len(s)) or take(self, s, i, u))
    best = treap._Best(20)
    treap._search(grid, np.array([grid.row[b"a"], grid.row[b"b"]]), np.array([3, 4]), best)
    assert best.ids.tolist() == list(range(1, 21))
    assert sum(scored) < 500


def test_awkward_and_empty(spark, awkward, no_docs):
    items = [(1, "one two THREE"), (1, "one two THREE"), (None, "id text long é"), (2, "1 x")]
    distinct = list(dict.fromkeys(items))
    assert ask(spark, awkward, items) == brute([(i, t) for i, t, *_ in AWKWARD], distinct)
    assert ask(spark, no_docs, items) == []
    assert ask(spark, awkward.filter("doc_id IN (3, 4, 5)"), items) == []
    assert treap.search(treap.index(awkward), treap.questions(no_docs.withColumnRenamed("doc_id", "item_id"))).count() == 0


def test_query_against_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in table_of(small, "documents")]
    items = [(r["item_id"], r["text"]) for r in table_of(small, "benchmark")]
    got = QUERIES["op13_ranked_search"](spark, small).collect()
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=repr) == brute(docs, items)
