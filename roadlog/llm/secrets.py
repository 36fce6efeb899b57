"""Secret scan: fixed formats, and strings too random to be anything else.

Besides the fixed formats, runs of 20 or more characters of the usual encodings
are put through a battery.  The encoding of a run is inferred from its
characters (decimal, hexadecimal, letters of one case or both, base 32, letters and
digits of one case, base 64 in both spellings; of a run of mixed spelling the pieces
between its separators).  Two questions decide:

* Could the run be uniform over its alphabet?  Chi-squared over the symbols, the number
  of runs above and below the middle of the alphabet, and the serial correlation of
  neighbours each have their law under uniform symbols; a run that one of them rejects
  at ``Settings.reject`` is no key.
* Could it be ordinary?  What ordinary looks like is counted over all documents: how
  often each character follows each other one in the distinct words and identifiers of the
  corpus that are shorter than a key.  The chance of an ordinary string to be so many times more likely under the
  uniform law than under the counted one is at most one in that many (Markov's
  inequality), which is the p-value of the run.  It falls with length, and is divided
  among the encodings and pieces tried.

Over all tested runs of the table the share of false finds is held by the step-up rule of
Benjamini and Hochberg with weights that grow with length (mean one).  The rule
needs only how many weighted p-values fall into each cell of a fixed grid, so a
histogram is what leaves the tasks; p-values are rounded up to their cell, on the
safe side.  The counts of neighbours are a table of fixed size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlog.llm.common import map_batches, utf8_bytes
from roadlog.workspace import written

# fixed values: kinds in the order of the report
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# a key may stand between separators, and a separator may belong to its alphabet
_PIECES = [re.compile(rf"[A-Za-z0-9{keep}]{{20,}}={{0,2}}") for keep in ("", "+/", "_-")]

# fixed values: encodings from the narrowest, each with its symbols in order
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower26": _LOWER,
    "upper26": _UPPER,
    "base32": _UPPER + "234567",
    "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER,
    "mixed52": _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SYMBOLS = {name: frozenset(symbols) for name, symbols in ENCODINGS.items()}
_PLACES = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in ENCODINGS.items()}


@dataclass(frozen=True)
class Settings:
    """``rate``: the share of false finds that is aimed at.  ``reject``: the level at which
    each test of the battery rejects that a run is uniform.  ``unseen``: the share of
    neighbours that are thought to follow no counted habit."""

    rate: float = 0.01
    reject: float = 1e-4
    unseen: float = 0.02
    cells: int = 2048


def encoding_of(run: str) -> str | None:
    """The narrowest encoding that has all characters of a run."""
    symbols = frozenset(run.rstrip("="))
    return next((name for name, s in _SYMBOLS.items() if symbols <= s), None) if symbols else None


def _normal_above(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def _chi_squared_above(x: float, df: int) -> float:
    """P(chi-squared > x), by Wilson and Hilferty's cube root."""
    spread = 2 / (9 * df)
    return _normal_above(((x / df) ** (1 / 3) - 1 + spread) / math.sqrt(spread))


def battery(run: str, name: str) -> tuple[float, float, float]:
    """How likely uniform symbols of the encoding look so unevenly spread, keep so often
    or seldom to one half of the alphabet, and depend so much on their neighbours."""
    place, k = _PLACES[name], len(ENCODINGS[name])
    x = np.array([place[c] for c in run])
    n = len(x)
    counts = np.bincount(x, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    high = x >= k // 2
    share = (k // 2) / k
    expected = (n - 1) * (share**2 + (1 - share) ** 2)
    stays = int((high[1:] == high[:-1]).sum())
    away = (abs(stays - expected) - 0.5) / math.sqrt((n - 1) / 4)
    centred = x - x.mean()
    spread = float(centred @ centred)
    serial = float(centred[1:] @ centred[:-1]) / spread + 1 / n if spread else 1.0
    return _chi_squared_above(chi, k - 1), 2 * _normal_above(away), 2 * _normal_above(abs(serial) * math.sqrt(n))


# --- what ordinary strings look like ------------------------------------------

# characters of runs; the last place stands for the start of a word, also behind a separator
_ALPHABET = _UPPER + _LOWER + _DIGITS + "+/-_"
_AT = {c: i for i, c in enumerate(_ALPHABET)}
_START = len(_ALPHABET)
# other bytes become blanks
_WORD_BYTES = bytes(c if chr(c) in _AT else 32 for c in range(256))
# words between separators, each with the separator behind it; what is as long as a
# run might be a key and tells nothing about habits
_SHORT = re.compile(rb"(?<![A-Za-z0-9+])[A-Za-z0-9+]{1,19}(?![A-Za-z0-9+])[/_-]?")
# distinct words that a task holds at once
_HELD = 100_000


def _places_before(x: np.ndarray) -> np.ndarray:
    """For the places of a word's characters, those of the characters before them."""
    before = np.concatenate([[_START], x[:-1]])
    return np.where(np.isin(before, [_AT["/"], _AT["-"], _AT["_"]]), _START, before)


def short_words(text: bytes) -> Iterator[bytes]:
    """The words of a text whose neighbours count."""
    for word in set(text.translate(_WORD_BYTES).split()):
        if len(word) < 20 and word.isalnum():
            yield word
        else:
            yield from _SHORT.findall(word)


def words(docs: DataFrame) -> DataFrame:
    """``word``: the distinct words of letters and digits of all documents, of under 20
    characters, each with a separator behind it if there is one.

    Every word counts once however often it is there, so that what was copied a
    thousand times does not become a habit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[bytes] = set()
        for batch in batches:
            for text in utf8_bytes(batch.column(0)):
                held.update(short_words(text))
                if len(held) >= _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary())], names=["word"])
                    held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary())], names=["word"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "word binary").distinct()


def neighbours(docs: DataFrame) -> np.ndarray:
    """How often each character (column) follows each other one (row; the last row: starts
    a word) in the distinct words of the corpus."""
    width = len(_ALPHABET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(256, 0, np.int64)
        for c, i in _AT.items():
            table[ord(c)] = i
        counts = np.zeros((width + 1) * width, np.int64)
        for batch in batches:
            for word in batch.column(0):
                x = table[np.frombuffer(word.as_py(), np.uint8)]
                np.add.at(counts, _places_before(x) * width + x, 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["pair", "n"])

    pairs = words(docs).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((width + 1) * width)
    # a row a pair of characters
    for r in pairs.collect():
        counts[r.pair] = r.n
    return counts.reshape(width + 1, width)


def habits(counts: np.ndarray, s: Settings = Settings()) -> np.ndarray:
    """Logarithms of the chances that a character follows another one, from the counts:
    rows with few are drawn towards the average, and every pair is possible."""
    width = len(_ALPHABET)
    average = (counts.sum(axis=0) + 1) / (counts.sum() + width)
    seen = (counts + 20 * average) / (counts.sum(axis=1, keepdims=True) + 20)
    return np.log((1 - s.unseen) * seen + s.unseen / width)


def p_value(run: str, chances: np.ndarray, s: Settings = Settings()) -> float:
    """The chance that an ordinary string is so much likelier to be uniform; 1 where the
    battery rejects that it is."""
    run = run.rstrip("=")
    name = encoding_of(run)
    if name is None or min(battery(run, name)) < s.reject:
        return 1.0
    x = np.array([_AT[c] for c in run])
    ordinary = float(chances[_places_before(x), x].sum())
    uniform = -len(x) * math.log(len(ENCODINGS[name]))
    return min(1.0, len(ENCODINGS) * math.exp(min(0.0, ordinary - uniform)))


def tests_of(run: str, chances: np.ndarray, s: Settings = Settings()) -> tuple[int, int, float] | None:
    """``start, finish, p``: the most telling of a run and its pieces between separators,
    its p-value taken times their number; None if nothing can be tested."""
    tried = {(0, len(run))} | {m.span() for rule in _PIECES for m in rule.finditer(run)}
    tested = [(a, b, p_value(run[a:b], chances, s)) for a, b in sorted(tried) if encoding_of(run[a:b]) is not None]
    if not tested:
        return None
    a, b, p = min(tested, key=lambda t: (t[2], t[0] - t[1]))
    return a, b, min(1.0, p * len(tested))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed formats, sorted."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _candidates(docs: DataFrame, s: Settings) -> DataFrame:
    """A row a document: fixed spans, and of each other run its place, length and p-value."""
    chances = docs.sparkSession.sparkContext.broadcast(habits(neighbours(docs), s))

    def tested(m: re.Match) -> dict | None:
        found = tests_of(m[0], chances.value, s)
        return found and {"start": m.start() + found[0], "finish": m.start() + found[1], "p": found[2]}

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        base, runs = [], []
        for text in batch.column(1):
            text = text.as_py()
            spans = base_spans(text)
            base.append([{"start": a, "kind": k, "finish": b} for a, k, b in spans])
            others = (
                m for m in _RUN.finditer(text) if not any(a <= m.start() and m.end() <= b for a, _, b in spans)
            )
            runs.append([t for t in map(tested, others) if t])
        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("finish", pa.int32())])
        cand = pa.struct([("start", pa.int32()), ("finish", pa.int32()), ("p", pa.float64())])
        return [batch.column(0), pa.array(base, pa.list_(span)), pa.array(runs, pa.list_(cand))]

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return map_batches(
        rows,
        run,
        "doc_id long,"
        "base array<struct<start:int,kind:int,finish:int>>,"
        "runs array<struct<start:int,finish:int,p:double>>",
    )


def threshold_cell(histogram: dict[int, int], s: Settings) -> int:
    """The least cell whose runs are finds under the step-up rule; ``cells`` if none is."""
    tests = sum(histogram.values())
    found, best = 0, s.cells
    for cell in sorted(histogram, reverse=True):
        found += histogram[cell]
        if 10 ** (-cell / 16) <= s.rate * found / tests:
            best = cell
    return best


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, spans, n_tested`` for every row of ``docs (doc_id, text)``; ``spans`` are
    ``(start, kind, finish)`` in code points, sorted, ``kind`` an index into KINDS;
    ``n_tested`` counts the runs that were put through the battery.

    A null or empty text has no spans.  Spans of the fixed formats are all there;
    a random run that lies in one is not reported again.  Equal runs are tested
    wherever they stand.
    """
    s = settings
    rows = written(_candidates(docs, s), "secret-candidates")
    each = rows.select(F.explode("runs").alias("r")).select(
        (F.col("r.finish") - F.col("r.start")).alias("length"), F.col("r.p").alias("p")
    )
    mean_length = F.lit(each.agg(F.avg("length")).first()[0] or 1.0)

    def cell(length, p):
        weighted = F.greatest(p, F.lit(1e-300)) * mean_length / length
        place = F.floor(-16 * F.log10(weighted))
        return F.greatest(F.lit(0), F.least(F.lit(s.cells - 1), place)).cast("int")

    counted = each.groupBy(cell(F.col("length"), F.col("p")).alias("cell")).count()
    # at most `cells` rows
    cut = threshold_cell({r["cell"]: r["count"] for r in counted.collect()}, s)
    finds = F.transform(
        F.filter("runs", lambda r: cell(r["finish"] - r["start"], r["p"]) >= cut),
        lambda r: F.struct(
            r["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), r["finish"].alias("finish")
        ),
    )
    return rows.select(
        "doc_id", F.array_sort(F.concat("base", finds)).alias("spans"), F.size("runs").cast("long").alias("n_tested")
    )
