"""Quality classifier: hashed word n-grams, logistic regression, FTRL.

A text becomes a sparse vector: its words (runs of word characters, runs of
other printing characters; a word that repeats its neighbour becomes a mark, the
same for all words) and pairs of neighbouring words are hashed into
``2**bits`` buckets, counted, damped and scaled to length one.  Weights are
learnt with follow-the-regularised-leader updates, one row at a time, on a
bounded sample of the labelled rows: the sample is dealt into shards, a task
learns each, and the weights are averaged.  A score is the logistic function of
the dot product of the vector with the weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.llm.common import map_batches, texts
from roadlog.workspace import written

_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
KEPT_WORDS = 1 << 19
# stands for "the same word again"; no 32-bit hash
AGAIN = np.uint64(1 << 33)
# score from which a document counts as good
ACCEPT = 0.7


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are learnt from; ``shards`` are
    learnt side by side.  The others are the usual ones of the update rule."""

    bits: int = 18
    sample: int = 16_384
    shards: int = 4
    epochs: int = 5
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.02
    seed: int = 17


class _WordHashes(dict):
    """Word to 32-bit hash; forgets everything when full."""

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


class Features:
    """Texts to sparse vectors."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.hashes = _WordHashes()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Buckets in ascending order and their values; empty for a text without words."""
        words = _TOKENS(text)
        one = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        one[1:][one[1:] == one[:-1]] = AGAIN
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] + np.uint64(1)
        mixed = np.concatenate([one, two]) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        at, n = np.unique(mixed >> self.shift, return_counts=True)
        value = np.log1p(n)
        return at.astype(np.int32), (value / max(np.sqrt(value @ value), 1e-12)).astype(np.float32)


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def _probability(w: np.ndarray, at: np.ndarray, value: np.ndarray) -> float:
    """Of label 1, for a sparse vector; the last weight is the bias."""
    return float(_sigmoid(float(w[at] @ value) + float(w[-1])))


def learn(rows: Iterator[tuple[int, np.ndarray, np.ndarray]], s: Settings) -> np.ndarray:
    """Weights after ``epochs`` passes over ``(label, buckets, values)`` in the given
    order; the last weight is the bias."""
    rows = list(rows)
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(z_at: np.ndarray, n_at: np.ndarray) -> np.ndarray:
        over = np.sign(z_at) * np.maximum(np.abs(z_at) - s.l1, 0.0)
        return -over / ((s.beta + np.sqrt(n_at)) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for label, at, value in rows:
            at, value = np.append(at, size - 1), np.append(value, 1.0)
            z_at, n_at = z[at], n[at]
            w = weights(z_at, n_at)
            gradient = (_sigmoid(w @ value) - label) * value
            squared = gradient * gradient
            z[at] = z_at + gradient - (np.sqrt(n_at + squared) - np.sqrt(n_at)) / s.alpha * w
            n[at] = n_at + squared
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, settings: Settings = Settings()) -> np.ndarray:
    """Averaged weights, learnt from ``labels (doc_id, quality)`` and the texts.

    ``may_learn`` is a condition on ``doc_id``.  Of more than ``settings.sample``
    labelled documents, those with the smallest hashes of ``doc_id`` are learnt
    from.  Rows without ``doc_id`` or label are left out; of several labels of a
    document the largest counts; a repeated document is learnt from repeatedly.
    Without any labelled row all weights are zero.
    """
    spark, s = docs.sparkSession, settings
    order = F.xxhash64(F.col("doc_id").cast("long"), F.lit(s.seed))
    chosen = (
        labels.filter(may_learn & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("label"))
        .orderBy(order, "doc_id")
        .limit(s.sample)
    )

    def vectors(batch: pa.RecordBatch) -> list[pa.Array]:
        of = Features(s.bits)
        both = [of(t.as_py()) for t in batch.column(2)]
        return [
            batch.column(0),
            batch.column(1),
            pa.array([b.tobytes() for b, _ in both], pa.binary()),
            pa.array([v.tobytes() for _, v in both], pa.binary()),
        ]

    # at most `sample` ids and labels, a few hundred KB
    rows = map_batches(
        texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"),
        vectors,
        "doc_id long, label int, buckets binary, vals binary",
    )

    def learn_shard(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["place", "doc_id", "buckets"])
        sparse = zip(shard["label"], shard["buckets"], shard["vals"])
        w = learn(
            ((y, np.frombuffer(b, np.int32), np.frombuffer(v, np.float32)) for y, b, v in sparse), s
        )
        return pd.DataFrame({"w": [w.tobytes()]})

    place = F.xxhash64("doc_id", F.lit(s.seed + 1))
    learnt = written(
        rows.select("*", place.alias("place"), F.pmod(place, F.lit(s.shards)).alias("shard"))
        .groupBy("shard")
        .applyInPandas(learn_shard, "w binary"),
        "quality-weights",
    )
    # one vector of fixed size from each shard
    each = [np.frombuffer(r.w, np.float64) for r in learnt.collect()]
    return np.mean(each, axis=0) if each else np.zeros((1 << s.bits) + 1)


def score(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, score`` for every row; an empty text scores by the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    bits = settings.bits

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        w, of = sent.value, Features(bits)
        scores = (_probability(w, *of(t.as_py())) for t in batch.column(1))
        return [batch.column(0), pa.array(scores, pa.float64())]

    return map_batches(texts(docs), run, "doc_id long, score double")


def accepted(docs: DataFrame, weights: np.ndarray, settings: Settings = Settings(), least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    bits = settings.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, of = sent.value, Features(bits)
        for batch in batches:
            texts_ = (t.as_py() or "" for t in batch.column("text"))
            keep = [_probability(w, *of(t)) >= least for t in texts_]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
