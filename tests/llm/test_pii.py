import hashlib
import random
import re
import time

import pytest
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of
from pyspark.sql import functions as F

from roadlog.llm import pii
from roadlog.llm.queries import QUERIES


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


def small_number(part):
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def plain(text):
    """The fixed formats by the expressions as they are stated."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(map(small_number, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def base_of(rows):
    return sorted(
        ((r["doc_id"], [(s["start"], s["kind"], s["finish"]) for s in r["spans"] if s["kind"] < 4]) for r in rows),
        key=repr,
    )


def test_random_texts(spark):
    rnd = random.Random(6)
    bits = ["a", "b.c", "@", "x.yz", ".", "-", " ", "+", "1", "23", "0", "255", "256", "(", ")", "4111 1111 1111 1111", "%", "_", "é", "\n", "\U0001f600"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30)))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = base_of(found(docs.select("doc_id", pii.base_spans().alias("spans"))))
    assert got == sorted(((i, plain(t)) for i, t in rows), key=repr)


def test_ip_parts_that_are_zero(spark):
    good = ["10.0.0.1", "0.0.0.0", "127.0.0.1", "192.168.0.12", "010.000.1.255", "00.1.2.3", "0" * 30_000 + ".0.0.0"]
    bad = ["256.0.0.1", "10.0.0.0256", "0.0.0", "0" * 30_000 + "256.0.0.0", "0.0.0." + "0" * 30_000 + "999"]
    rows = [(i, f"from {t} on") for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = base_of(found(docs.select("doc_id", pii.base_spans().alias("spans"))))
    assert got == sorted(((i, plain(t)) for i, t in rows), key=repr)
    ips = {i: [(a, b) for a, k, b in spans if k == 1] for i, spans in got}
    assert [ips[i] for i in range(len(rows))] == [[(5, 5 + len(t))] for t in good] + [[] for _ in bad]


def test_query(spark, small):
    got = {r["doc_id"]: r for r in found(QUERIES["op7_pii"](spark, small))}
    docs = table_of(small, "documents")
    assert len(got) == len(docs)
    for d in docs:
        base = plain(d["text"])
        named = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = got[d["doc_id"]]
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        assert set(filter(None, named.split(","))) <= set(r["spans"].split(","))


def believed(edges, s):
    """Trusted patterns by dictionaries."""
    score = {e: float(seed) for e, seed in edges.items()}
    patterns = {p for p, _ in edges}

    def beliefs():
        return {
            p: sum(score[e] for e in edges if e[0] == p) / (1 + sum(e[0] == p for e in edges)) for p in patterns
        }

    for _ in range(s.rounds):
        b = beliefs()
        for p, i in edges:
            if not edges[p, i]:
                miss = 1.0
                for q, j in edges:
                    if j == i:
                        miss *= 1 - b[q]
                score[p, i] = 1 - miss
    b = beliefs()
    return {p for p in patterns if b[p] >= s.trust and sum(edges[e] for e in edges if e[0] == p) >= s.seeds}


def test_scores_against_dictionaries(spark):
    rnd = random.Random(7)
    for _ in range(3):
        seeds = {f"i{k}": k < 25 for k in range(50)}
        edges = {}
        for _ in range(160):
            p = rnd.randint(0, 7)
            i = f"i{rnd.randint(0, 27 if p < 4 else 49)}"
            edges[f"p{p}", i] = seeds[i]
        df = spark.createDataFrame([(*e, v) for e, v in edges.items()], "pattern string, instance string, seed boolean")
        s = pii.Settings(trust=0.75)
        assert {r["pattern"] for r in found(pii.trusted_patterns(df, s))} == believed(edges, s)


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please write to user{i}@mail.example.com soon") for i in range(12)]
    rows += [(100, "Please WRITE TO (user-99-at-mail) soon"), (101, "version number 4.12345 is out"), (102, "write to 42")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["kind"], s["finish"]) for s in r["spans"]] for r in found(pii.scan(docs))}
    assert got[100] == [(17, 4, 32)] and rows[12][1][17:32] == "user-99-at-mail"
    assert got[101] == [] and got[102] == []
    assert all(len(got[i]) == 1 for i in range(12))


@pytest.mark.parametrize("n", [1, 63, 64, 65, 130, 5000])
def test_places_of_many_matches(spark, n):
    rnd = random.Random(n)
    text = "".join(" " * rnd.randint(1, 3) + rnd.choice(["é1", "x22", "3"]) for _ in range(n)) + " end"
    df = spark.createDataFrame([(text,)], "text string")
    got = found(df.select(F.explode(pii.matches("text", "[0-9]+")).alias("m")).select("m.*"))
    expected = list(re.finditer("[0-9]+", text))
    assert [(r["start"], r["finish"], r["value"]) for r in got] == [(m.start(), m.end(), m[0]) for m in expected]
    ends = [0, *(m.end() for m in expected)]
    starts = [*(m.start() for m in expected), len(text)]
    assert [r["gap"] for r in got] == [text[a:b] for a, b in zip(ends, starts)][:-1]
    assert [r["after"] for r in got] == [text[a:b] for a, b in zip(ends, starts)][1:]


def test_a_log_of_a_megabyte(spark):
    """The work grows with the matches."""
    docs = spark.createDataFrame([(1, "id 12345 at 10.0.0.1 " * 48_000)], "doc_id long, text string")
    start = time.time()
    (row,) = found(pii.scan(docs).select(F.size(F.filter("spans", lambda x: x["kind"] == 1)).alias("n")))
    assert row["n"] == 48_000 and time.time() - start < 120


def test_one_word_before_or_behind_discovers_too(spark):
    rows = [(i, f"w{'x' * (i % 9)} mail user{i}@mail.example.com q{'y' * (i % 7)} z") for i in range(30)]
    rows += [(50 + i, f"r{'x' * (i % 9)} s 10.1.2.{i} replied z") for i in range(30)]
    rows += [(100, "some mail kim_1984 there"), (101, "and then lee-77-x replied"), (102, "version 4.12345 replies")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["kind"], s["finish"]) for s in r["spans"]] for r in found(pii.scan(docs))}
    assert got[100] == [(10, 4, 18)] and got[101] == [(9, 4, 17)] and got[102] == []


def test_awkward(spark, awkward, no_docs):
    assert base_of(found(pii.scan(awkward))) == sorted(((i, plain(t or "")) for i, t, *_ in AWKWARD), key=repr)
    assert found(pii.scan(no_docs)) == []


def test_no_python_on_the_main_path(spark, small, capsys):
    for name in ("op6_hilbert_shards", "op7_pii", "op8_perspectives", "op10_fingerprints"):
        QUERIES[name](spark, small).explain()
        assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_luhn(spark):
    numbers = ["4111111111111111", "4111111111111112", "79927398713", "0"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    got = {r["n"]: r["ok"] for r in found(df.select("n", pii.passes_luhn(F.col("n")).alias("ok")))}
    assert got == {n: luhn(n) for n in numbers}
