import zlib

import numpy as np
import pytest
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of
from pyspark.sql import functions as F

from roadlog.llm import quality
from roadlog.llm.queries import QUERIES

TENTH = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in found(QUERIES["op2_quality"](spark, TENTH))}


def test_held_out_rows_are_told_apart(scored):
    labels = [r for r in table_of(TENTH, "labels") if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(scored[r["doc_id"]]["held_out"] for r in labels)
    right = [scored[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert len(right) > 500 and np.mean(right) > 0.98
    bad = [scored[r["doc_id"]]["score"] for r in labels if not r["quality"]]
    good = [scored[r["doc_id"]]["score"] for r in labels if r["quality"]]
    above = np.mean([b < g for b in bad for g in good])
    assert above > 0.995


def test_every_document_once(scored):
    docs = table_of(TENTH, "documents")
    assert set(scored) == {d["doc_id"] for d in docs}
    for i, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_held_out_labels_are_never_learnt(spark):
    docs = spark.createDataFrame([(i, f"word{i % 2} and more") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(F.col("doc_id") < 20, 1 - F.col("quality")).otherwise(F.col("quality")))
    late = F.col("doc_id") >= 20
    assert np.array_equal(quality.train(docs, labels, late), quality.train(docs, turned, late))


def test_one_update_by_hand():
    s = quality.Settings(bits=2, epochs=1, alpha=1.0, beta=1.0, l1=0.0, l2=0.0)
    w = quality.learn(iter([(1, np.array([1], np.int32), np.array([1.0], np.float32))]), s)
    # gradient -1/2: z = -1/2, n = 1/4, so w = 1/2 / (1 + 1/2)
    assert w.tolist() == pytest.approx([0, 1 / 3, 0, 0, 1 / 3])


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    few = quality.train(docs, labels, F.lit(True), quality.Settings(sample=5, shards=1, epochs=1))
    more = quality.train(docs, labels, F.lit(True), quality.Settings(sample=50, shards=1, epochs=1))
    assert np.abs(more).sum() > np.abs(few).sum() > 0


def test_awkward(spark, awkward, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, 0), (None, 1), (5, None), (99, 1)], "doc_id long, quality int"
    )
    weights = quality.train(awkward, labels, F.lit(True))
    rows = found(quality.score(awkward, weights))
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(empty) == 1
    kept = quality.accepted(awkward, weights, least=0.0)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
    nothing = quality.train(no_docs, labels, F.lit(True))
    assert not nothing.any()
    assert found(quality.score(no_docs, nothing)) == [] and quality.accepted(no_docs, nothing).count() == 0
