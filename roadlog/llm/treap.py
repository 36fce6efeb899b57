"""Ranked search over treaps of a grid of terms and documents.

Documents are dealt into blocks.  A block is a grid, a row a term and a column a
document, with the impact of the term in the document in its cells.  The grid is kept
as a quadtree without its empty quarters: level by level four bits for each cell that
is not empty, and the largest impact below it as the difference from the cell above.

A question descends the paths of its terms through the tree together.  What waits are
ranges of documents, each with the cells its terms have come to; the sum of their
largest impacts, weighted, is more than any document of the range can score.  The most
promising ranges are halved first; a range of one document has its score; ranges that
cannot enter the best so far are dropped.  A range whose bound only ties with the last
of the best is dropped if its least ``doc_id`` cannot settle the tie, so thousands of
copies of one text cost a question no more than a few of them.

The index is a table.  Questions are broadcast in parts of a fixed size, each against
all blocks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlog.llm.common import texts, utf8_bytes
from roadlog.workspace import written

# columns of a block, and filled cells after which it is closed early
BLOCK_DOCS = 8192
BLOCK_CELLS = 1 << 21
# questions broadcast at once (bytes), and asked terms that are worth a restricted index
PART_BYTES = 16 << 20
# ranges halved at once
STEP = 48
# stands for a null doc_id: it comes last
_NO_ID = 2**63 - 1

# bytes that are no part of a term become blanks, A-Z become a-z
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

_BLOCK = (
    "ids array<long>, terms array<binary>, holders array<int>, height int, sizes array<int>, "
    "masks binary, drops binary, widths array<int>"
)
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)


class Index(NamedTuple):
    """Blocks of the grid; documents with a term, and terms in them."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order: letters and digits, and whatever is not
    ASCII; A-Z in lower case."""
    return text.translate(_FOLD).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n`` of every text: its terms, with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array((len(terms_of(t)) for t in utf8_bytes(batch.column(1))), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=["doc_id", "n"])

    return texts(docs).mapInArrow(run, "doc_id long, n long")


# --- a block ------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2**31 at every second place."""
    x = x.astype(np.int64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << shift)) & mask
    return x


def tree_of(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int):
    """Four bits for each cell that is not empty and is divided, and the largest impact
    below each cell; both by level from the root."""
    code = 2 * _spread(rows) + _spread(columns)
    order = np.argsort(code, kind="stable")
    code, masks, tops = code[order], [], [impacts[order]]
    for _ in range(height):
        quarter, above = (1 << (code & 3)).astype(np.uint8), code >> 2
        start = np.flatnonzero(np.diff(above, prepend=-1))
        masks.append(np.bitwise_or.reduceat(quarter, start))
        tops.append(np.maximum.reduceat(tops[-1], start))
        code = above[start]
    return masks[::-1], tops[::-1]


class _Builder:
    """Gathers documents until they fill a block."""

    def __init__(self, n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.vocabulary: dict[bytes, int] = {}
        self.rows: list[int] = []
        self.counts: list[int] = []
        self.per_doc: list[int] = []

    def add(self, doc_id: int | None, length: int, counts: Iterable[tuple[bytes, int]]) -> None:
        before = len(self.rows)
        for term, n in counts:
            self.rows.append(self.vocabulary.setdefault(term, len(self.vocabulary)))
            self.counts.append(n)
        if len(self.rows) > before:
            self.ids.append(doc_id)
            self.lengths.append(length)
            self.per_doc.append(len(self.rows) - before)

    def full(self, block_docs: int) -> bool:
        return len(self.ids) >= block_docs or len(self.rows) >= BLOCK_CELLS

    def block(self) -> tuple | None:
        if not self.ids:
            return None
        # Python's whole numbers: 25 * n * N may pass 64 bits
        m = np.array([75 + 25 * n * self.n_docs // self.n_terms for n in self.lengths], np.int64)
        tf = np.array(self.counts, np.int64)
        doc = np.repeat(np.arange(len(m)), self.per_doc)
        impacts = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        # alike documents and alike terms side by side, so that bounds are close
        ids = np.array([_NO_ID if i is None else i for i in self.ids], np.int64)
        by_length = np.lexsort((ids, m))
        column = np.empty(len(m), np.int64)
        column[by_length] = np.arange(len(m))
        first_row = np.array(self.rows, np.int64)
        best = np.zeros(len(self.vocabulary), np.int64)
        np.maximum.at(best, first_row, impacts)
        by_best = np.argsort(-best, kind="stable")
        row = np.empty(len(best), np.int64)
        row[by_best] = np.arange(len(best))
        height = max(1, (max(len(m), len(best)) - 1).bit_length())
        masks, tops = tree_of(row[first_row], column[doc], impacts, height)
        drops, widths = [tops[0].astype("<u4")], [4]
        for mask, above, below in zip(masks, tops, tops[1:]):
            less = np.repeat(above, _BITS[mask]) - below
            widths.append(np.min_scalar_type(less.max()).itemsize)
            drops.append(less.astype(f"<u{widths[-1]}"))
        terms = list(self.vocabulary)
        return (
            [self.ids[i] for i in by_length],
            [terms[i] for i in by_best],
            np.bincount(first_row, minlength=len(best))[by_best].tolist(),
            height,
            [len(t) for t in tops],
            b"".join(x.tobytes() for x in masks),
            b"".join(x.tobytes() for x in drops),
            widths,
        )


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [
        pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()),
        pa.binary(), pa.binary(), pa.list_(pa.int32()),
    ]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def index(docs: DataFrame, only: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> Index:
    """The grid over all terms of ``docs``, or over those in ``only (term)``.

    ``only`` saves rows of the grid that nobody asks for; it is used when its counted
    bytes allow to broadcast it, and changes no answer.  Every row of ``docs`` is a
    document, rows without or with the same ``doc_id`` too; those without a term count
    for nothing.
    """
    counted = term_counts(docs).agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = counted.docs, counted.terms or 0
    spark = docs.sparkSession
    asked = None
    if only is not None:
        size = only.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
        if size <= PART_BYTES:
            asked = spark.sparkContext.broadcast(frozenset(bytes(r.term) for r in only.select("term").collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = _Builder(n_docs, n_terms)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8_bytes(batch.column(1))):
                terms = terms_of(text)
                counts = Counter(terms)
                wanted = counts.items() if asked is None else [(t, counts[t]) for t in counts.keys() & asked.value]
                builder.add(doc_id, len(terms), wanted)
                if builder.full(block_docs):
                    yield _table([builder.block()])
                    builder.clear()
        last = builder.block()
        if last:
            yield _table([last])

    return Index(written(texts(docs).mapInArrow(run, _BLOCK), "term-grid"), n_docs, n_terms)


def holders(index: Index) -> DataFrame:
    """``term, df``: the documents that hold each term of the index."""
    return (
        index.blocks.select(F.explode(F.arrays_zip("terms", "holders")).alias("x"))
        .groupBy(F.col("x.terms").alias("term"))
        .agg(F.sum(F.col("x.holders").cast("long")).alias("df"))
    )


# --- questions ----------------------------------------------------------------


def questions(items: DataFrame, id_col: str = "item_id") -> DataFrame:
    """``item, id, term, n``: the distinct terms of every distinct row ``(id, text)``, and
    how often each is there; ``item`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = Counter(terms_of(next(utf8_bytes(batch.column(2).slice(i, 1)))))
                own = pa.array([batch.column(0)[i].as_py()] * len(counts), pa.int64())
                name = pa.array([batch.column(1)[i].as_py()] * len(counts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [own, name, pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                    names=["item", "id", "term", "n"],
                )

    rows = texts(items, id_col).distinct().withColumn("item", F.monotonically_increasing_id())
    numbered = written(rows.select("item", "doc_id", "text"), "questions")
    return numbered.mapInArrow(run, "item long, id long, term binary, n long")


class _Grid:
    """A block opened for search."""

    def __init__(self, block: dict) -> None:
        self.height, sizes = block["height"], block["sizes"]
        self.row = {t: i for i, t in enumerate(block["terms"])}
        self.ids = np.array([_NO_ID if i is None else i for i in block["ids"]], np.int64)
        self.unnamed = np.array([i is None for i in block["ids"]])
        masks = np.frombuffer(block["masks"], np.uint8).astype(np.int64)
        self.masks, self.first, self.tops, at, byte = [], [], [], 0, 0
        for level, (size, width) in enumerate(zip(sizes, block["widths"])):
            less = np.frombuffer(block["drops"], f"<u{width}", size, byte).astype(np.int64)
            byte += size * width
            above = np.repeat(self.tops[-1], _BITS[self.masks[-1]]) - less if level else less
            self.tops.append(above)
            if level < self.height:
                mask = masks[at : at + size]
                at += size
                self.masks.append(mask)
                self.first.append(np.cumsum(_BITS[mask]) - _BITS[mask])
        # the least id of each range of documents, by level
        wide = np.full(1 << self.height, _NO_ID, np.int64)
        wide[: len(self.ids)] = self.ids
        self.least = [wide]
        for _ in range(self.height):
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))
        self.least.reverse()


class _Best:
    """The best documents so far: by score, then by id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    def could_enter(self, bounds: np.ndarray, least: np.ndarray) -> np.ndarray:
        if len(self.scores) < self.k:
            return bounds > 0
        last = self.scores[-1]
        return (bounds > last) | ((bounds == last) & (least < self.ids[-1]))

    def take(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        unnamed = np.concatenate([self.unnamed, unnamed])
        first = np.lexsort((unnamed, ids, -scores))[: self.k]
        self.scores, self.ids, self.unnamed = scores[first], ids[first], unnamed[first]


def _search(grid: _Grid, rows: np.ndarray, weights: np.ndarray, best: _Best) -> None:
    """Descend the paths of ``rows`` together."""
    height = grid.height
    # what waits, by level: bounds, ranges, and a cell for each term (-1: empty)
    waiting: list[tuple | None] = [None] * (height + 1)
    waiting[0] = (
        np.array([(weights * grid.tops[0][0]).sum()]),
        np.zeros(1, np.int64),
        np.zeros((1, len(rows)), np.int64),
    )
    while True:
        level, most = -1, 0
        for at, pool in enumerate(waiting):
            # of equal bounds the smallest ranges first: they are next to a score
            if pool is not None and pool[0][0] >= most:
                level, most = at, pool[0][0]
        if level < 0:
            return
        bounds, ranges, cells = waiting[level]
        alive = best.could_enter(bounds, grid.least[level][ranges])
        if not alive.all():
            bounds, ranges, cells = bounds[alive], ranges[alive], cells[alive]
        waiting[level] = (bounds[STEP:], ranges[STEP:], cells[STEP:]) if len(bounds) > STEP else None
        if not len(bounds):
            continue
        ranges, cells = ranges[:STEP], cells[:STEP]
        held = cells >= 0
        mask, first = grid.masks[level][cells], grid.first[level][cells]
        row_bit = rows >> (height - 1 - level) & 1
        below = []
        for side in (0, 1):
            quarter = 2 * row_bit + side
            there = held & (mask >> quarter & 1 == 1)
            cell = np.where(there, first + _BITS[mask & (1 << quarter) - 1], -1)
            bound = (weights * np.where(there, grid.tops[level + 1][cell], 0)).sum(axis=1)
            below.append((bound, 2 * ranges + side, cell))
        bounds, ranges, cells = (np.concatenate(x) for x in zip(*below))
        alive = best.could_enter(bounds, grid.least[level + 1][ranges])
        bounds, ranges, cells = bounds[alive], ranges[alive], cells[alive]
        if not len(bounds):
            continue
        if level + 1 == height:
            best.take(bounds, grid.ids[ranges], grid.unnamed[ranges])
            continue
        if waiting[level + 1] is not None:
            bounds, ranges, cells = (np.concatenate(x) for x in zip(waiting[level + 1], (bounds, ranges, cells)))
        order = np.lexsort((grid.least[level + 1][ranges], -bounds))
        waiting[level + 1] = bounds[order], ranges[order], cells[order]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(index: Index, asked: DataFrame, k: int = 20) -> DataFrame:
    """``item, id, rank, doc_id, score``: the ``k`` best documents of every question.

    ``asked`` are the rows of :func:`questions`.  A term that is in ``n`` documents of
    ``N`` weighs ``floor(1000 ln((2 N + 2) / (2 n + 1)))``, once for each time it is in
    the question; documents score the weighted sum of its impacts there, above 0.
    Equal scores are ranked by ``doc_id``, null last.
    """
    packed = written(
        asked.join(holders(index), "term")
        .groupBy("item", "id")
        .agg(F.collect_list(F.struct("term", "n", "df")).alias("terms"), F.sum(F.octet_length("term") + 24).alias("size")),
        "packed-questions",
    )
    spark = packed.sparkSession
    parts = max(1, -(-(packed.agg(F.sum("size")).first()[0] or 0) // PART_BYTES))
    part_of = F.pmod(F.xxhash64("item"), F.lit(parts))
    names = ["item", "doc_id", "score"]
    schema = "item long, doc_id long, score long"
    found = None
    for part in range(parts):
        rows = packed.filter(part_of == part).select("item", "terms").collect()
        told = spark.sparkContext.broadcast(
            [(r.item, [(bytes(t.term), t.n * weight(index.n_docs, t.df)) for t in r.terms]) for r in rows]
        )
        found_here = index.blocks.mapInArrow(_searcher(told, k, names), schema)
        found = found_here if found is None else found.unionByName(found_here)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .join(packed.select("item", "id"), "item")
        .select("item", "id", "rank", "doc_id", "score")
    )


def _searcher(told, k: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, _Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                grid = _Grid(batch.slice(i, 1).to_pylist()[0])
                for item, terms in told.value:
                    mine = [(grid.row[t], w) for t, w in terms if t in grid.row and w]
                    if mine:
                        rows, weights = np.array(mine, np.int64).T
                        _search(grid, rows, weights, best.setdefault(item, _Best(k)))
        for item, held in best.items():
            ids = pa.array(held.ids, pa.int64(), mask=held.unnamed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(ids), pa.int64()), ids, pa.array(held.scores, pa.int64())], names=names
            )

    return run
