import random

from llm.helpers import AWKWARD, awkward, found, no_docs, table_of

from roadlog.llm import line_dedup
from roadlog.llm.queries import QUERIES

BLANKS = " \t\n\x0b\f\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_chars=10, min_docs=2):
    """Rows with an id of their own."""
    holders = {}
    for i, text in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders.setdefault(key, []).append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key_of(x), ())) < min_docs or min(holders[key_of(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def rows_of(df):
    return [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found(df)]


def test_against_brute_force(spark):
    rnd = random.Random(4)
    pool = [f"{'  ' * (i % 3)}Line NUMBER {i} é{'!' * (i % 4)}{chr(9) * (i % 2)}" for i in range(60)] + ["short", "", "x" * 9]

    def text():
        lines = [rnd.choice(pool) for _ in range(rnd.randint(0, 12))]
        return "\n".join(rnd.choice([str.upper, str.lower, str.strip, str])(x) for x in lines)

    rows = [(i * 3 - 40, text()) for i in range(150)] + [(900, None), (901, "\n"), (902, "a very common line\r\n" * 500)]
    rows += [(1000 + i, "A very common line") for i in range(200)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(rows_of(line_dedup.dedup_lines(docs))) == brute(rows)
    assert sorted(rows_of(line_dedup.dedup_lines(docs, 3, 4))) == brute(rows, 3, 4)


def test_rows_without_or_with_the_same_id(spark):
    line = "this line is shared"
    rows = [(None, f"a\n{line}"), (None, f"a\n{line}"), (None, f"b\n{line}"), (5, f"c\n{line}"), (5, f"d\n{line}"), (6, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(rows_of(line_dedup.dedup_lines(docs)), key=str)
    # the least id keeps the line, in both of its rows
    assert got == sorted(
        [(None, 2, 1, "a")] * 2 + [(None, 2, 1, "b"), (5, 2, 0, f"c\n{line}"), (5, 2, 0, f"d\n{line}"), (6, 1, 1, "")], key=str
    )
    unnamed = spark.createDataFrame(rows[:3], "doc_id long, text string")
    kept = sorted(r[3] for r in rows_of(line_dedup.dedup_lines(unnamed)))
    assert kept in (["a", "a", f"b\n{line}"], [f"a\n{line}", f"a\n{line}", "b"])


def test_awkward_and_empty(spark, awkward, no_docs):
    got = rows_of(line_dedup.dedup_lines(awkward))
    assert len(got) == len(AWKWARD)
    by_text = {(r[0], r[3]) for r in got}
    assert (1, "one Two three") in by_text and (2, "") in by_text and (13, "") in by_text and (3, "") in by_text
    assert (7, "long " * 40_000) in by_text
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_query_against_brute_force(spark, small):
    import hashlib

    rows = [(r["doc_id"], r["text"]) for r in table_of(small, "documents")]
    expected = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)]
    got = QUERIES["op12_line_dedup"](spark, small).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == expected
    assert any(r.n_dropped for r in got)
