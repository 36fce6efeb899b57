"""Exact dedup of arriving documents against what is already there.

The distinct digests of the documents already there ("history") are kept in an
index of minimal perfect hashes: digests are dealt into buckets of bounded size,
and a bucket holds, for each of its digests, one slot with the full digest, the
locator of the row that stays (the largest ``doc_id``) and the number of rows.
Levels of bits lead to the slot: on each level the digests not yet placed are
hashed to positions, those alone on a position own its bit, the others go on to
the next level; the slot is the number of set bits before.  A lookup finds the
only slot a digest can be in and compares all its bytes, so a digest that was
never there is recognised and takes the other way: it is grouped with its equals
among the arrivals.

Only digests, locators and counts are shuffled.  Rows are shrunk to one for each
distinct digest before they meet the index, so thousands of copies of one text
are no more work for a bucket than a single one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.llm.common import map_batches, utf8_bytes
from roadlog.workspace import written

# digests in a bucket, about; buckets follow the number of rows
BUCKET = 1024
# bits of a level for each digest that is to be placed
ROOM = 2
DIGEST = 32
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# stands for a null doc_id inside: it counts as the least
_NO_ID = -(2**63)


def digests(docs: DataFrame, fresh: Column | None = None) -> DataFrame:
    """``doc_id, fresh, digest``: SHA-256 of each whole text after lower-casing A-Z only.

    ``fresh`` tells arrivals from history (default: everything is an arrival; a
    null condition means history).  A null text counts as the empty text.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        # lower() of bytes changes A-Z and nothing else
        hashed = (hashlib.sha256(t.lower()).digest() for t in utf8_bytes(batch.column(2)))
        return [batch.column(0), batch.column(1), pa.array(hashed, pa.binary())]

    flag = F.lit(True) if fresh is None else F.coalesce(fresh, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        flag.alias("fresh"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return map_batches(rows, run, "doc_id long, fresh boolean, digest binary")


def _words(digest_bytes: bytes) -> np.ndarray:
    return np.frombuffer(digest_bytes, "<u8").reshape(-1, DIGEST // 8)


def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where digests fall on a level (another word and mix on each level)."""
    x = words[:, level % words.shape[1]] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and their bits, one after the other."""
    sizes, levels, rest = [], [], words
    while len(rest):
        size = ROOM * len(rest) + 1
        at = _positions(rest, len(sizes), size)
        own = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(own)
        rest = rest[~own[at]]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def slots_of(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The only slot each digest can be in; -1 if there is none."""
    before = np.cumsum(bits) - bits
    slots = np.full(len(words), -1, np.int64)
    offset = 0
    for level, size in enumerate(sizes):
        open_ = np.flatnonzero(slots < 0)
        at = offset + _positions(words[open_], level, size)
        hit = bits[at]
        slots[open_[hit]] = before[at[hit]]
        offset += size
    return slots


def _bucket(n_buckets: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("int").alias("bucket")


INDEX_SCHEMA = "bucket int, sizes array<int>, bits binary, digests binary, winners binary, counts binary"


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """The index over ``digest, winner, n`` (distinct digests), a row a bucket."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        words = _words(b"".join(rows["digest"]))
        sizes, bits = perfect_hash(words)
        order = np.argsort(slots_of(words, sizes, bits))
        return pd.DataFrame(
            {
                "bucket": [rows["bucket"].iloc[0]],
                "sizes": [sizes],
                "bits": [np.packbits(bits).tobytes()],
                "digests": [words[order].tobytes()],
                "winners": [rows["winner"].to_numpy("<i8")[order].tobytes()],
                "counts": [rows["n"].to_numpy("<i8")[order].tobytes()],
            }
        )

    dealt = history.select(_bucket(n_buckets), "digest", "winner", "n")
    return dealt.groupBy("bucket").applyInPandas(build, INDEX_SCHEMA)


def lookup(index: DataFrame, asked: DataFrame, n_buckets: int) -> DataFrame:
    """``digest, winner, n`` of the index for every distinct ``digest`` asked;
    both null where the bytes in the slot differ or there is no slot."""

    def find(asked_rows: pd.DataFrame, buckets: pd.DataFrame) -> pd.DataFrame:
        winner = pd.array([pd.NA] * len(asked_rows), "Int64")
        n = pd.array([pd.NA] * len(asked_rows), "Int64")
        for held in buckets.itertuples():
            words, there = _words(b"".join(asked_rows["digest"])), _words(held.digests)
            bits = np.unpackbits(np.frombuffer(held.bits, np.uint8), count=int(sum(held.sizes))).astype(bool)
            slots = slots_of(words, [int(s) for s in held.sizes], bits)
            same = (slots >= 0) & (there[slots] == words).all(axis=1)
            winner[same] = np.frombuffer(held.winners, "<i8")[slots[same]]
            n[same] = np.frombuffer(held.counts, "<i8")[slots[same]]
        return pd.DataFrame({"digest": asked_rows["digest"], "winner": winner, "n": n})

    dealt = asked.select(_bucket(n_buckets), "digest")
    return (
        dealt.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(find, "digest binary, winner long, n long")
    )


def deduplicate(docs: DataFrame, fresh: Column) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row of ``docs``.

    ``fresh`` tells arrivals from history.  Of equal texts the row with the
    largest ``doc_id`` stays, old or new.  Rows without ``doc_id`` lose to any row
    that has one; a group of such rows alone has ``keep_id`` null and stays.  Rows
    that repeat ``doc_id`` and text count as members and stay or go together.
    """
    rows = written(digests(docs, fresh), "digests")
    n_buckets = max(1, -(-rows.count() // BUCKET))
    lowest = F.lit(_NO_ID)
    known = (
        rows.filter(~F.col("fresh"))
        .groupBy("digest")
        .agg(F.coalesce(F.max("doc_id"), lowest).alias("winner"), F.count("*").alias("n"))
    )
    index = written(build_index(known, n_buckets), "digest-index")
    asked = written(
        rows.groupBy("digest").agg(
            F.max(F.when(F.col("fresh"), F.col("doc_id"))).alias("new_winner"),
            F.sum(F.col("fresh").cast("long")).alias("new_n"),
        ),
        "digests-asked",
    )
    found = lookup(index, asked, n_buckets)
    stays = (
        asked.join(found, "digest")
        .select(
            "digest",
            F.greatest(F.nullif("winner", lowest), "new_winner").alias("keep_id"),
            (F.coalesce("n", F.lit(0)) + F.col("new_n")).alias("group_size"),
        )
    )
    return rows.join(stays, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def distinct_documents(docs: DataFrame, fresh: Column) -> DataFrame:
    """One row of each text, with all its columns: the one with the largest ``doc_id``.

    Of rows that repeat both text and ``doc_id``, and of rows of a text that has no
    ``doc_id`` at all, any one stays.  Columns may be of any type.
    """
    lowered = F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower())
    own = [
        F.unhex(F.sha2(lowered.cast("binary"), 256)).alias("_digest"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_kept_id"),
    ]
    stays = written(
        deduplicate(docs, fresh)
        .filter("kept")
        .groupBy(F.col("digest").alias("_digest"), F.coalesce("doc_id", F.lit(_NO_ID)).alias("_kept_id"))
        .agg(F.count("*").alias("_n")),
        "kept-digests",
    )
    key = ["_digest", "_kept_id"]
    rows = docs.select("*", *own)
    # rows that are alike in both are few, as a rule none; only they are gathered
    one = rows.join(stays.filter("_n = 1").drop("_n"), key, "left_semi")
    several = rows.join(stays.filter("_n > 1").drop("_n"), key, "left_semi").dropDuplicates(key)
    return one.unionAll(several).select(*docs.columns)
