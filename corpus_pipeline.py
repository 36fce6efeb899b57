"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that its predecessor kept (written as Parquet and
read again) and returns what it keeps, with the columns of ``documents``; the last
returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlog.llm import bpe, exact_dedup, minhash, mixing, quality
from roadlog.llm.common import table
from roadlog.llm.queries import default_codec, held_out, later_half, mix_levels
from roadlog.workspace import written

# five words a shingle, four fifths in common; a pair at the threshold shares no
# band with probability (1 - 0.8 ** 5) ** 40, about 1e-7
NEAR = minhash.Settings(width=5, percent=80, bands=40, rows=5)
# tokens of the mixture, of all that are left
SHARE = (3, 4)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts, judged each by its text."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out())
    return quality.accepted(docs, weights)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.distinct_documents(docs, later_half())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.representatives(docs, NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may come several times."""
    return mixing.mixed_documents(docs, mixing.mix(docs, mix_levels(), share=SHARE))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, same`` of every row: ``ids`` as little-endian unsigned
    32-bit integers, ``same`` whether they decode to the text."""
    found = bpe.round_trip(docs, default_codec(spark))
    return found.select("doc_id", bpe.n_tokens("ids").alias("n_tokens"), "ids", "same")


STAGES = [
    ("quality", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixture", mix_sources),
    ("tokens", encode),
]

# the classifier has no SQL; the tests compare with a brute-force pipeline
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
