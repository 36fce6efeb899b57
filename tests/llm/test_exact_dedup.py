import hashlib
import random

import numpy as np
from llm.helpers import AWKWARD, awkward, found, no_docs
from pyspark.sql import functions as F

from roadlog.llm import exact_dedup


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(lowered(text), []).append(i)
    out = []
    for i, text, *_ in rows:
        ids = groups[lowered(text)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lowered(text).encode()).digest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(
        ((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in found(df)), key=repr
    )


def test_perfect_hash_is_minimal_and_finds_no_strangers():
    rnd = np.random.default_rng(3)
    words = rnd.integers(0, 2**63, (3000, 4), dtype=np.uint64)
    words[1000:2000, 1:] = words[:1000, 1:]  # digests that differ in one word only
    sizes, bits = exact_dedup.perfect_hash(words)
    slots = exact_dedup.slots_of(words, sizes, bits)
    assert sorted(slots) == list(range(3000))
    strangers = exact_dedup.slots_of(rnd.integers(0, 2**63, (500, 4), dtype=np.uint64), sizes, bits)
    assert ((strangers >= -1) & (strangers < 3000)).all()


def test_awkward_however_it_is_split(spark, awkward):
    for fresh in (F.lit(True), F.lit(False), F.col("doc_id") % 2 == 0, F.col("doc_id") > 5):
        assert rows_of(exact_dedup.deduplicate(awkward, fresh)) == brute(AWKWARD)


def test_members_and_strangers(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["Hot"] * 30 + [f"t{rnd.randint(0, 400)}"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(exact_dedup.deduplicate(docs, F.col("doc_id") >= 1500)) == brute(rows)


def test_documents_that_stay(spark, awkward, no_docs):
    kept = exact_dedup.distinct_documents(awkward, F.col("doc_id") > 5)
    assert kept.columns == awkward.columns
    # one row of each text, the one with the largest id
    expected = {}
    for i, text, *_ in AWKWARD:
        expected.setdefault(lowered(text), []).append(i)
    expected = {t: max((i for i in ids if i is not None), default=None) for t, ids in expected.items()}
    assert sorted(((lowered(r["text"]), r["doc_id"]) for r in found(kept)), key=str) == sorted(expected.items(), key=str)
    assert exact_dedup.distinct_documents(no_docs, F.lit(True)).count() == 0
    assert exact_dedup.deduplicate(no_docs, F.lit(False)).count() == 0


def test_rows_without_or_with_shared_ids(spark):
    rows = [(None, "A text here"), (None, "a text here"), (5, "dup"), (5, "unique"), (9, "DUP"), (9, "DUP"), (None, "unique")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "map('k', text) AS more", "1 AS _n")
    for fresh in (F.lit(True), F.col("doc_id") == 5, F.lit(False)):
        kept = sorted(((r["doc_id"], lowered(r["text"])) for r in found(exact_dedup.distinct_documents(docs, fresh))), key=str)
        assert kept == [(5, "unique"), (9, "dup"), (None, "a text here")]
