"""Chunks of one order of actions against a greedy loop."""

import random

import pytest
from conftest import rows

from roadlog.operators import bulk, keyed


def greedy(sizes, size, max_bytes):
    chunks, n, used, number = [], 0, 0, 0
    for s in sizes:
        if n and (n == size or used + s > max_bytes):
            number, n, used = number + 1, 0, 0
        chunks.append(number)
        n, used = n + 1, used + s
    return chunks


def actions(spark, sizes, partitions=3):
    """Lines of the given sizes, in shuffled rows; every third without a source."""
    made = []
    for seq, s in enumerate(sizes):
        made.append((seq * 2 - 7, "a" * (s - 1), None) if seq % 3 == 0 else (seq * 2 - 7, "a" * (s // 2 - 1), "b" * (s - s // 2 - 1)))
    random.Random(1).shuffle(made)
    return spark.createDataFrame(made, "seq long, action_line string, source_line string").repartition(partitions)


@pytest.mark.parametrize(
    "size, max_bytes, bits, groups",
    [(5, 40, 3, 1), (16, 100, 4, 10), (1, 9, 2, 1), (500, 60, 16, 10), (7, 10**9, 0, 2)],
)
def test_equals_one_greedy_loop(spark, monkeypatch, size, max_bytes, bits, groups):
    monkeypatch.setattr(bulk, "_GROUP_BITS", groups)
    rnd = random.Random(size)
    sizes = [rnd.choice([4, 5, 9, 13, 30, 70]) for _ in range(400)]
    got = rows(bulk.chunk_stream(actions(spark, sizes, rnd.randint(1, 6)), size, max_bytes, bits), "seq")
    assert [r["seq"] for r in sorted(got, key=lambda r: r["seq"])] == [2 * i - 7 for i in range(400)]
    assert [r["chunk"] for r in sorted(got, key=lambda r: r["seq"])] == greedy(sizes, size, max_bytes)
    assert sum(r["bytes"] for r in got) == sum(sizes)


def test_bodies_are_the_chunks(spark):
    sizes = [random.Random(3).choice([4, 6, 20]) for _ in range(50)]
    df = actions(spark, sizes)
    lines = {r.seq: r.action_line + "\n" + (r.source_line + "\n" if r.source_line is not None else "") for r in df.collect()}
    expected = {}
    for seq, chunk in zip(sorted(lines), greedy(sizes, 4, 50)):
        expected[chunk] = expected.get(chunk, "") + lines[seq]
    got = {r["chunk"]: r for r in rows(bulk.stream_bodies(df, 4, 50, 3))}
    assert {c: r["payload"] for c, r in got.items()} == expected
    assert all(r["bytes"] == len(expected[c]) and r["n"] <= 4 for c, r in got.items())


def test_few_or_no_actions(spark):
    assert bulk.chunk_stream(actions(spark, [])).count() == 0
    assert [tuple(r) for r in bulk.chunk_stream(actions(spark, [9]), 1, 1).collect()] == [(0, -7, 9)]


def test_all_failures_of_a_chunk_are_told(spark):
    results = spark.createDataFrame(
        [(i, "create", "", f"d{i}", 409 if i in (4, 6) else 201, i not in (4, 6), None) for i in range(10)],
        "seq long, op string, _index string, _id string, status int, ok boolean, error string",
    )
    chunks = results.selectExpr("seq", "seq DIV 4 AS chunk")
    with pytest.raises(Exception, match=r"2 document\(s\) failed to index: .*d4.*d6"):
        keyed.raise_on_failed_chunks(results, chunks).collect()
    fine = keyed.raise_on_failed_chunks(results.filter("ok"), chunks)
    assert fine.count() == 8 and set(fine.columns) == {*results.columns, "chunk"}
