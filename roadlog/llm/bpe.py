"""Byte-level BPE: encode texts to token ids and back.

The merges are reproduced without merging.  Of every stretch of text that the
pattern cuts, an Aho-Corasick automaton over the vocabulary (bytes read as
Latin-1, so that positions are bytes) gives the longest token that starts at
each byte.  The encoder takes the longest token that can stand beside its left
neighbour, shortens it along its prefixes when it cannot, and steps back when
nothing fits; a byte position found to be a dead end is never tried again, so
the work is linear in the length.  Two tokens can stand side by side exactly
when the merge rules would not have joined across their border; that is read
from the way each token is built, and remembered.
"""

from __future__ import annotations

import base64
import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.llm.common import map_batches, texts

# bounds of what a task remembers (entries), and the longest remembered stretch
KEPT_STRETCHES = 1 << 18
KEPT_LENGTH = 64
KEPT_PAIRS = 1 << 17


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Vocabulary:
    """Tables of one vocabulary, built once for each Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.cut = regex.compile(pattern).findall
        self.token = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[int, bool] = {}
        self.packed = _Packed(self)
        self._build()
        self.automaton = ahocorasick.Automaton()
        for rank in self.halves:
            self.automaton.add_word(self.token[rank].decode("latin-1"), rank)
        self.automaton.make_automaton()

    def _build(self) -> None:
        """How each token comes about.  A token that no merge reaches stays out."""
        for token, rank in sorted(self.ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
                continue
            for cut in range(len(token) - 1, 0, -1):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left in self.halves and right in self.halves and self._stand(left, right):
                    self.halves[rank], self.joined[left, right] = (left, right), rank
                    break
        for rank in self.halves:
            token = self.token[rank]
            prefixes = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p in self.halves), None)

    def _facing(self, rank: int, side: int) -> list[tuple[int, float]]:
        """The parts of a token that lie at one of its ends (``side`` of their halves), from
        the byte up to the token, each with the rank of the merge that swallows it."""
        parts, gone = [], math.inf
        while True:
            parts.append((rank, gone))
            half = self.halves[rank][side]
            if half == rank:
                return parts[::-1]
            gone, rank = rank, half

    def _stand(self, left: int, right: int) -> bool:
        """Would merging in rank order leave a border between the two tokens?

        Follows the merges on both sides of the border in the order of their ranks.
        Two parts that face each other are joined if the merge of both comes before
        either is swallowed; of equal ranks the merge further left comes first, which
        is the one that swallows the left part, or the one across the border before
        the one that swallows the right part.
        """
        before, after = iter(self._facing(left, 1)), iter(self._facing(right, 0))
        (a, a_gone), (b, b_gone) = next(before), next(after)
        while True:
            both = self.joined.get((a, b), math.inf)
            if both < a_gone and both <= b_gone and both < math.inf:
                return False
            if a_gone == b_gone == math.inf:
                return True
            if a_gone <= b_gone:
                a, a_gone = next(before)
            else:
                b, b_gone = next(after)

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            known = self.fits[pair] = self._stand(left, right)
        return known

    def encode_stretch(self, stretch: bytes) -> list[int]:
        whole = self.ranks.get(stretch)
        if whole is not None:
            return [whole]
        length, shorter, n = self.length, self.shorter, len(stretch)
        longest: list[int | None] = [None] * (n + 1)
        for end, rank in self.automaton.iter(stretch.decode("latin-1")):
            longest[end + 1 - length[rank]] = rank
        open_end = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, rank = 0, longest[0]
        while at < n:
            while rank is not None:
                if open_end[at + length[rank]] and (not out or self.compatible(out[-1], rank)):
                    break
                rank = shorter[rank]
            if rank is None:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                open_end[at] = 0
                rank = out.pop()
                at -= length[rank]
            else:
                out.append(rank)
                at += length[rank]
                rank = longest[at]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text, each as four bytes, lowest first."""
        return b"".join(map(self.packed.__getitem__, self.cut(text)))


class _Packed(dict):
    """Stretch of text to its packed ids; forgets everything when full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, stretch: str) -> bytes:
        ids = self.vocabulary.encode_stretch(stretch.encode())
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(stretch) <= KEPT_LENGTH:
            if len(self) >= KEPT_STRETCHES:
                self.clear()
            self[stretch] = ids
        return ids


class Codec:
    """A vocabulary on its way to the tasks.

    The ranks are read on the driver (a vocabulary file is a parameter of fixed
    size) and broadcast; a Python worker builds its tables once and keeps them
    beside the ranks for its later tasks.
    """

    def __init__(self, spark, path: str, pattern: str):
        self._sent = spark.sparkContext.broadcast({"ranks": read_ranks(path), "pattern": pattern})

    def encoder(self) -> Vocabulary:
        kept = self._sent.value
        if "encoder" not in kept:
            kept["encoder"] = Vocabulary(kept["ranks"], kept["pattern"])
        return kept["encoder"]

    def tokens(self) -> dict[int, bytes]:
        kept = self._sent.value
        if "tokens" not in kept:
            kept["tokens"] = {rank: token for token, rank in kept["ranks"].items()}
        return kept["tokens"]


def encode(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text, packed as little-endian
    unsigned 32-bit integers (the layout of a token file).

    Each match of the pattern is encoded separately; no special tokens.  A null
    or empty text gives no ids; rows that repeat are encoded again.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        encode_text = codec.encoder().encode
        return [batch.column(0), pa.array((encode_text(t.as_py()) for t in batch.column(1)), pa.binary())]

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, ids binary")


def decode(encoded: DataFrame, codec: Codec) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes the ids stand for."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        token = codec.tokens().__getitem__
        back = (b"".join(map(token, unpacked(i.as_py() or b""))) for i in batch.column(1))
        return [batch.column(0), batch.column(1), pa.array(back, pa.binary())]

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, same``: the ids, and whether they decode to the bytes of the text."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        encode_text, token = codec.encoder().encode, codec.tokens().__getitem__
        ids, same = [], []
        for text in batch.column(1):
            text = text.as_py()
            ids.append(encode_text(text))
            same.append(b"".join(map(token, unpacked(ids[-1]))) == text.encode())
        return [batch.column(0), pa.array(ids, pa.binary()), pa.array(same, pa.bool_())]

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, ids binary, same boolean")


def n_tokens(ids: str = "ids") -> Column:
    return F.shiftright(F.octet_length(ids), 2).cast("long")


def unpacked(ids: bytes) -> list[int]:
    """Packed ids as numbers, for readers of the result."""
    return np.frombuffer(ids, "<u4").tolist()
