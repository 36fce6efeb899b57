import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of

from roadlog.llm import bpe
from roadlog.llm.queries import QUERIES, default_codec

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.Vocabulary(ranks, public_tokenizers.PATTERN)


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_random_texts_encode_as_by_merging(vocabulary, reference, ranks):
    rnd = random.Random(5)
    pieces = [t.decode("latin-1") for t in ranks]
    for _ in range(1500):
        glued = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9)))
        letters = "".join(rnd.choice("abetrn sio") for _ in range(rnd.randint(1, 60)))
        for text in (glued, letters):
            assert vocabulary.encode(text) == packed(reference.encode_ordinary(text))


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 20_000, "ab" * 20_000, "é" * 9_000, "\x1c\x85᠎ 12", "<|endoftext|>"])
def test_long_stretches_and_odd_characters(vocabulary, reference, text):
    assert vocabulary.encode(text) == packed(reference.encode_ordinary(text))


def test_small_vocabulary_steps_back():
    # "abc" is the longest start of "abcd", yet merging gives ab + cd
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 257, b"abc": 258}
    vocabulary = bpe.Vocabulary(ranks, r"[a-z]+")
    merged = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abc", "abcabcd", "cdabcd", "aabccd"):
        assert bpe.unpacked(vocabulary.encode(text)) == merged.encode_ordinary(text)


def test_query(spark, small, reference):
    got = {r["doc_id"]: r for r in found(QUERIES["op1_byte_bpe"](spark, small))}
    docs = table_of(small, "documents")
    assert len(got) == len(docs)
    for d in docs:
        ids = packed(reference.encode_ordinary(d["text"]))
        assert got[d["doc_id"]] == {
            "doc_id": d["doc_id"],
            "n_tokens": len(ids) // 4,
            "ids_sha256": hashlib.sha256(ids).hexdigest(),
            "decoded_sha256": hashlib.sha256(d["text"].encode()).hexdigest(),
        }


def test_awkward(spark, awkward, no_docs, reference):
    codec = default_codec(spark)
    rows = found(bpe.decode(bpe.encode(awkward, codec), codec))
    expected = [(i, packed(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in AWKWARD]
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in rows), key=repr) == sorted(expected, key=repr)
    assert all(r["same"] for r in found(bpe.round_trip(awkward, codec)))
    assert found(bpe.decode(bpe.encode(no_docs, codec), codec)) == []
