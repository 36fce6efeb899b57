"""Near-duplicates by word shingles: sketch, band, verify, connect.

A document's set holds the hashes of its distinct shingles.  The sketch of a set
has ``bins`` coordinates, filled in rounds: in a round every element is hashed to
a bin and a value, and a bin keeps the smallest value of the first round that
reaches it; after ``bins`` such rounds, each bin still empty takes the smallest
value over the whole set under a hash of its own.  So every coordinate fills,
each agrees between two sets with the probability of their likeness, and the work
is about one pass over the set plus ``bins * log(bins)``.

Documents with the same set are one class, whatever their ids; a class has a number,
and its least ``doc_id`` is only a label that is read at the end.  Of the classes that share the key of a band, the least is the centre, and every other is
compared with it on full sets: a bucket of any size costs one pair a member.
That settles nearly all.  What a centre can miss is a link between two members
that it is not linked with itself, so the classes that candidate pairs hang
together are then compared within their cluster, except those that are known to
share a centre.  Clusters are cut into blocks, a task compares two blocks, and
only links that join something are handed on.  Pairs that agree in no band are
never seen; ``Settings`` says how rare that is.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlog.llm.common import map_batches, texts, utf8_bytes
from roadlog.llm.graph import components
from roadlog.operators.ordered import positions
from roadlog.workspace import written

KEPT_WORDS = 1 << 19
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash; forgets everything when full."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


def shingles(text: bytes, hashes: WordHashes, width: int) -> np.ndarray:
    """Ascending distinct hashes of the shingles of a text in UTF-8.

    A-Z count as a-z; words are what ASCII white space separates.  A text of
    fewer words than ``width`` is one shingle, a text without words none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(codes))
    n = len(codes) - width + 1
    rolled = np.full(n, np.uint64(width))
    for i in range(width):
        rolled = mix(rolled * _ODD[1] + codes[i : i + n])
    return np.unique(rolled)


def _set_key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """``bins`` coordinates (32 bits each) of a non-empty set."""
    out = np.zeros(bins, np.uint32)
    empty = np.ones(bins, bool)
    n, done = len(elements), 0
    while done < bins and empty.any():
        # as many rounds at once as make a worthwhile array
        rounds = np.arange(done, min(bins, done + max(1, 2 * bins // n)), dtype=np.uint64)
        x = mix(mix(elements[None, :] + (rounds[:, None] + np.uint64(1)) * _ODD[0])).ravel()
        at = ((x >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        value = x & np.uint64(0xFFFFFFFF)
        order = np.lexsort((value, np.repeat(rounds, n), at))
        first = order[np.flatnonzero(np.diff(at[order], prepend=np.uint64(bins)))]
        first = first[empty[at[first].astype(np.int64)]]
        filled = at[first].astype(np.int64)
        out[filled], empty[filled] = value[first], False
        done += len(rounds)
    for b in np.flatnonzero(empty):
        out[b] = (mix(mix(elements + np.uint64((bins + int(b) + 1) * 0x9E3779B97F4A7C15 % 2**64))) >> np.uint64(32)).min()
    return out


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each run of ``rows`` coordinates, different from band to band."""
    bands = coordinates.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(bands), dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mix(key * _ODD[2] + bands[:, i])
    return key


@dataclass(frozen=True)
class Settings:
    """``width`` words a shingle; documents are linked when ``100 * common >= percent * all``.

    A pair at the threshold shares no band with probability
    ``(1 - (percent / 100) ** rows) ** bands``, 4e-7 by default.
    """

    width: int = 3
    percent: int = 85
    bands: int = 25
    rows: int = 5
    block: int = 512


def _row_key():
    """A hash of id and text, equal for rows that repeat both."""
    return F.xxhash64("doc_id", "text")


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, row_key, n_shingles, set_key, bands``; set key and bands are null without words."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        hashes = WordHashes()
        n, keys, bands = [], [], []
        for text in utf8_bytes(batch.column(2)):
            elements = shingles(text, hashes, s.width)
            n.append(len(elements))
            keys.append(_set_key(elements) if n[-1] else None)
            bands.append(
                band_keys(sketch(elements, s.bands * s.rows), s.rows).view(np.int64) if n[-1] else None
            )
        return [
            batch.column(0),
            batch.column(1),
            pa.array(n, pa.int64()),
            pa.array(keys, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
        ]

    return map_batches(
        texts(docs).select("doc_id", _row_key().alias("row_key"), "text"),
        run,
        "doc_id long, row_key long, n_shingles long, set_key binary, bands array<long>",
    )


def _sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """``node, elements`` of the classes ``wanted (node, set_key, row_key)``, one row each."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        hashes = WordHashes()
        found = [shingles(t, hashes, s.width) for t in utf8_bytes(batch.column(2))]
        # a row that only shares the hash of its id and text has another set
        own = pa.array([_set_key(e) == k.as_py() for e, k in zip(found, batch.column(1))], pa.bool_())
        return [batch.column(0).filter(own), pa.array([e.tobytes() for e in found], pa.binary()).filter(own)]

    # always by shuffle: the classes grow with the input, and so would a broadcast
    rows = (
        texts(docs)
        .select(_row_key().alias("row_key"), "doc_id", "text")
        .join(wanted.hint("merge"), "row_key")
        .dropDuplicates(["row_key", "node", "doc_id"])
    )
    return map_batches(rows.select("node", "set_key", "text"), run, "node long, elements binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Are two sets (ascending distinct numbers) similar enough?"""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Those of ``pairs (a, b)`` that are links."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        keep = [
            linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), s.percent)
            for x, y in zip(batch.column(2), batch.column(3))
        ]
        return [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)]

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b"
    )
    return map_batches(both.select("a", "b", "x", "y"), run, "a long, b long")


def links_within(
    nodes: np.ndarray, anchors: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links between the rows of a block (all ``sides`` equal) or of two blocks,
    as few as join the same things; rows with one anchor are joined already."""
    n = len(nodes)
    sizes = np.array([len(e) for e in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    group = np.unique(anchors, return_inverse=True)[1].copy()
    present = np.zeros(ids.max(initial=-1) + 1, np.int64)
    two = len(np.unique(sides)) > 1
    out = []
    for i in range(n):
        rest = group != group[i]
        rest[: i + 1] = False
        if two:
            rest &= sides != sides[i]
        rest &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
        if not rest.any():
            continue
        own = ids[starts[i] : starts[i] + sizes[i]]
        present[own] = 1
        common = np.add.reduceat(present[ids], starts)
        present[own] = 0
        for j in np.flatnonzero(rest & (100 * common >= percent * (sizes + sizes[i] - common))):
            if group[j] != group[i]:
                out.append((int(nodes[i]), int(nodes[j])))
                group[group == group[j]] = group[i]
    return out


def _dealt_in_blocks(members: DataFrame, size: int) -> DataFrame:
    """``cluster, i, j, side, node, anchor``: the members ``(cluster, node, anchor)`` of every
    pair of blocks that have something to compare.

    Blocks follow the anchors, so of the classes that one centre has confirmed, however
    many, nearly all stand in blocks of that anchor alone.  Two such blocks of one anchor
    are never paired: they are joined already.
    """
    placed = positions(members.select("cluster", "anchor", "node"), ["cluster", "anchor", "node"], "place").select(
        "cluster", "anchor", "node", F.expr(f"place div {size}").alias("block")
    )
    blocks = written(
        placed.groupBy("cluster", "block").agg(F.min("anchor").alias("low"), F.max("anchor").alias("high")),
        "cluster-blocks",
    )
    several, single = blocks.filter("low < high"), blocks.filter("low = high")
    # a block of several anchors meets every block of its cluster once, itself included
    first = several.select("cluster", F.col("block").alias("i"))
    all_ = blocks.select("cluster", F.col("block").alias("j"), (F.col("low") == F.col("high")).alias("alone"))
    met = first.join(all_, "cluster").filter(F.col("alone") | (F.col("i") <= F.col("j"))).select("cluster", "i", "j")
    # blocks of one anchor meet those of another one
    anchors = single.select("cluster", "low").distinct()
    apart = anchors.join(anchors.select("cluster", F.col("low").alias("other")), "cluster").filter("low < other")
    across = (
        apart.join(single.select("cluster", "low", F.col("block").alias("i")), ["cluster", "low"])
        .join(single.select("cluster", F.col("low").alias("other"), F.col("block").alias("j")), ["cluster", "other"])
        .select("cluster", "i", "j")
    )
    sides = F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))
    return (
        met.unionByName(across)
        .withColumn("side", F.explode(sides))
        .join(placed.withColumnRenamed("block", "side"), ["cluster", "side"])
        .select("cluster", "i", "j", "side", "node", "anchor")
    )


def _rest_of_clusters(pairs: DataFrame, stars: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links inside clusters of candidates that go past the centres."""
    anchors = (
        stars.select(F.col("b").alias("node"), F.col("a").alias("anchor"))
        .unionByName(stars.select(F.col("a").alias("node"), F.col("a").alias("anchor")))
        .groupBy("node")
        .agg(F.min("anchor").alias("anchor"))
    )
    members = written(
        components(pairs)
        .join(anchors, "node", "left")
        .select("node", F.col("component").alias("cluster"), F.coalesce("anchor", "node").alias("anchor")),
        "cluster-members",
    )
    open_clusters = (
        members.groupBy("cluster")
        .agg(F.min("anchor").alias("low"), F.max("anchor").alias("high"))
        .filter("low < high")
        .select("cluster")
    )
    dealt = _dealt_in_blocks(members.join(open_clusters, "cluster"), s.block)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = links_within(
            rows["node"].to_numpy(),
            rows["anchor"].to_numpy(),
            rows["side"].to_numpy(),
            [np.frombuffer(e, np.uint64) for e in rows["elements"]],
            s.percent,
        )
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (
        dealt.join(sets, "node")
        .groupBy("cluster", "i", "j")
        .applyInPandas(compare, "a long, b long")
    )


def _grouped(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, row_key, n_shingles, linked_as, component_id`` of every row: the number
    of its group (null without words), and the least ``doc_id`` of the group."""
    signed = written(signatures(docs, s), "signatures")
    # numbered once, in a table: no two sets share a number
    classes = written(
        signed.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("label"), F.min("row_key").alias("row_key"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    banded = classes.select("node", F.explode("bands").alias("band"))
    centres = (
        banded.groupBy("band")
        .agg(F.min("node").alias("a"), F.max("node").alias("high"))
        .filter("a < high")
        .select("band", "a")
    )
    pairs = written(
        banded.join(centres, "band").filter("node <> a").select("a", F.col("node").alias("b")).distinct(),
        "candidate-pairs",
    )
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = classes.select("node", "set_key", "row_key").join(nodes, "node", "left_semi")
    sets = written(_sets(docs, wanted, s), "shingle-sets")
    stars = written(_confirmed(pairs, sets, s), "star-links")
    links = written(stars.unionByName(_rest_of_clusters(pairs, stars, sets, s)), "links")
    # tables, so that the joins are plain ones whose large keys Spark can split
    hung = written(
        classes.select("set_key", "node", "label")
        .join(components(links), "node", "left")
        .select("set_key", F.coalesce("component", "node").alias("linked_as"), "component", "label"),
        "classes-in-groups",
    )
    least = written(
        hung.filter("component is not null")
        .groupBy(F.col("component").alias("linked_as"))
        .agg(F.min("label").alias("least")),
        "group-labels",
    )
    named = hung.join(least, "linked_as", "left").select(
        "set_key", "linked_as", F.when(F.col("component").isNull(), F.col("label")).otherwise(F.col("least")).alias("named")
    )
    return signed.join(named, "set_key", "left").select(
        "doc_id",
        "row_key",
        "n_shingles",
        "linked_as",
        F.when(F.col("linked_as").isNull(), F.col("doc_id")).otherwise(F.col("named")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``.

    ``component_id`` is the least ``doc_id`` that links lead to, ``kept`` tells
    whether it is the row's own.  A text without words is linked with nothing.  A
    null ``doc_id`` counts as the largest.  Rows that repeat a ``doc_id``, or have
    none, are judged each by its own text.
    """
    return (
        _grouped(docs, settings)
        .select("doc_id", "n_shingles", "component_id")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def representatives(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that stay, one of each group, with all their columns; rows equal in
    ``doc_id`` and text stay together.  Texts without words all stay."""
    kept = written(
        _grouped(docs, settings)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_kept_id"), F.col("row_key").alias("_kept_key"), "linked_as"),
        "kept-rows",
    )
    # those of a group that are left have one id
    keys = (
        kept.filter("linked_as is not null")
        .groupBy("linked_as")
        .agg(F.min("_kept_id").alias("_kept_id"), F.min("_kept_key").alias("_kept_key"))
        .drop("linked_as")
        .unionByName(kept.filter("linked_as is null").drop("linked_as"))
    )
    own = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
    return docs.join(
        keys, (own == F.col("_kept_key")) & F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi"
    )
