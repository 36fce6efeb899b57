import itertools
import zlib
from collections import Counter

import pytest
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of
from pyspark.sql import functions as F

from roadlog.llm import sharding
from roadlog.llm.queries import QUERIES


@pytest.mark.parametrize("bits, dimensions", [(1, 2), (2, 2), (4, 2), (2, 3), (3, 3), (2, 4), (5, 1)])
def test_curve_visits_neighbours(spark, bits, dimensions):
    cells = list(itertools.product(range(1 << bits), repeat=dimensions))
    df = spark.createDataFrame([(list(c),) for c in cells], "steps array<int>")
    rows = found(df.withColumn("at", sharding.hilbert_index(F.col("steps"), bits, dimensions)))
    rows.sort(key=lambda r: r["at"])
    assert [r["at"] for r in rows] == list(range(len(cells)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a["steps"], b["steps"])) == 1


def lawful(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    # runs of the curve
    rows = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in rows] == sorted(r["curve"] for r in rows)


def test_query(spark, small):
    rows = found(QUERIES["op6_hilbert_shards"](spark, small))
    lawful(rows, 16)
    expected = sorted((d["doc_id"], len(d["text"].encode()) + 1, zlib.crc32(d["text"].encode())) for d in table_of(small, "documents"))
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_hot_cell_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 50)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.lit("same text").alias("text"),
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        F.lit("en").alias("lang"),
    )
    lawful(found(sharding.assign(docs, 7)), 7)


def test_shards_are_narrow_and_written(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assigned = sharding.assign(docs, 8, numbers=("n_chars",))
    bounds = found(sharding.shard_bounds(assigned, ["source", "n_chars"]))
    assert sum(r["rows"] for r in bounds) == docs.count()
    sharding.write_shards(docs, assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"]) for r in found(back)) == sorted((r["doc_id"], r["text"]) for r in found(docs))
    assert back.select("shard").distinct().count() == 8


def test_a_filter_on_one_value_reads_few_shards(spark):
    folder = "/root/testdata/sf0.01"
    docs = table_of(folder, "documents")
    assigned = sharding.assign(spark.read.parquet(f"{folder}/documents.parquet"), 16)
    bounds = found(sharding.shard_bounds(assigned, ["source", "lang"]))
    read = {}
    for column in ("source", "lang"):
        rows = Counter(d[column] for d in docs)
        read[column] = {v: sum(b[f"{column}_min"] <= v <= b[f"{column}_max"] for b in bounds) for v in rows}
    assert max(read["source"].values()) <= 10 and sorted(read["source"].values())[len(read["source"]) // 2] <= 8
    # English is most of the rows
    assert min(read["lang"].values()) <= 6


def test_steps_of_texts_follow_their_order_and_frequency(spark):
    values = ["b"] * 50 + ["a"] * 10 + ["c"] * 20 + ["é"] * 10 + ["d"] * 10 + [None] * 5
    rows = spark.createDataFrame([(v,) for v in values], "w string")
    assert sharding.text_cuts(rows, "w", 10) == [("b", 1), ("c", 6), ("d", 8), ("é", 9)]
    got = found(rows.select("w", sharding.quantised(rows, (), ("w",), 3)[0].alias("step")).distinct())
    assert {r["w"]: r["step"] for r in got} == {"a": 0, "b": 0, "c": 4, "d": 6, "é": 7, None: 0}


def test_awkward(spark, awkward, no_docs):
    rows = found(sharding.assign(awkward, 4))
    lawful(rows, 4)
    expected = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in AWKWARD), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == expected
    assert found(sharding.assign(no_docs, 4)) == []
