"""Cheapest repair of conversations whose turns are lost, blank, repeated or mislabelled.

Rows are dealt by conversation and turn, sorted, and streamed through a dynamic
program over the states of the turn grammar ``(s?(ua)+)?``.  It runs from the last
row of a conversation to the first and carries its costs across Arrow batches; for
every row it leaves one byte, the best edit from each state (a backpointer).

A giant conversation is not one task.  Its rows are cut into pieces of at most
``2**PIECE_BITS`` rows, by their place in the order.  A piece is summed up by the
cheapest way from each state before it to each state behind it; one row a piece is
then streamed backwards through the conversation to tell what the rows behind a
piece cost, and once more forwards to tell in which state a piece is entered.
Backpointers, codes and states of the pieces are tables in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.workspace import written

BLANKS = " \t\n\x0b\f\r"
# rows of a piece, as a power of two
PIECE_BITS = 14

# edits, in the order that settles ties
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5

# states of the grammar: nothing yet, after system, after user, after assistant
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = STATES = range(4)
# a turn is its initial: system, user, assistant, anything else
INITIALS = "sua"
_S, _U, _A, _OTHER = range(4)
_GOES = {
    (START, _S): AFTER_SYSTEM,
    (START, _U): AFTER_USER,
    (AFTER_SYSTEM, _U): AFTER_USER,
    (AFTER_USER, _A): AFTER_ASSISTANT,
    (AFTER_ASSISTANT, _U): AFTER_USER,
}
# the one turn that can be made up in a state, by its initial
_MADE = [_U, _U, _A, _U]
ROLE_NAMES = {_U: "user", _A: "assistant"}
# what is missing at the end of a conversation, by state
_MISSING = [0, 2, 1, 0]
_END = tuple(INSERT_COST * n for n in _MISSING)

# a row's fault, and its code: 4 * fault + initial
SOUND, TRUNCATED, MUST_GO = range(3)
_FAR = 1 << 60
# adjacent initials that are as they should be
_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}

# a row that is made up before a row comes in parts 0, 1, ..., the row itself last
_OWN_PART = 8


class Repaired(NamedTuple):
    """``rows``: ``conv_key, place, part, role, text``, the repaired conversations in the
    order of ``place, part``; ``report``: one row a conversation."""

    rows: DataFrame
    report: DataFrame


# --- rows in their order, and what is wrong with them -------------------------


def conv_key(conv_id: Column) -> Column:
    """The conversation as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_key, turn, role, text`` with planted faults, which follow from
    ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties its text, 2 removes
    ``. ! ?``, 3 repeats it, 4 makes its role ``user``.  Nulls count as one blank, but
    a null turn stays null."""
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    rows = conversations.select(
        conv_key(F.col("conv_id")).alias("conv_key"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("kind"),
    ).filter("kind <> 0")
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_key",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """``conv_key, turn, role, text`` with ``place``, a long that grows along the
    conversation: by turn (null first), role and text.  The places of a conversation
    are consecutive within a range of rows that one task has sorted."""
    start = F.left(F.col("text"), F.lit(32))
    return written(
        rows.select("conv_key", "turn", "role", "text", start.alias("_start"))
        .repartitionByRange("conv_key", "turn", "role", "_start")
        .sortWithinPartitions("conv_key", "turn", "role", "text")
        .drop("_start")
        .withColumn("place", F.monotonically_increasing_id()),
        "turns",
    )


def with_faults(placed: DataFrame) -> DataFrame:
    """``conv_key, place, turn, initial, fault`` of the rows: the first that applies of
    blank, duplicate (role and text stood earlier in the conversation) and truncated;
    else null."""
    ended = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    narrow = placed.select(
        "conv_key",
        "place",
        "turn",
        F.left(F.col("role"), F.lit(1)).alias("initial"),
        (ended == "").alias("blank"),
        (~ended.isin(".", "!", "?")).alias("cut"),
        F.xxhash64("role", "text").alias("_said1"),
        F.xxhash64(F.lit(1), "text", "role").alias("_said2"),
    )
    said = ["conv_key", "_said1", "_said2"]
    # written, so that the join has its own shuffle of the rows, which may be split
    again = written(
        narrow.filter(~F.col("blank"))
        .groupBy(*said)
        .agg(F.min("place").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n"),
        "said-again",
    )
    repeats = F.coalesce(F.col("place") > F.col("_first"), F.lit(False))
    return narrow.join(again, said, "left").select(
        "conv_key",
        "place",
        "turn",
        "initial",
        F.when(F.col("blank"), "blank").when(repeats, "duplicate").when(F.col("cut"), "truncated").alias("fault"),
    )


# --- the dynamic program ------------------------------------------------------


def _back_one(behind: tuple, code: int) -> tuple[tuple, int]:
    """Costs before a row from the costs behind it, and the row's backpointers: two
    bits for each state."""
    fault, initial = divmod(code, 4)
    costs, edits = [], 0
    for state in STATES:
        ways = [(DELETE_COST + behind[state], DELETE)]
        if fault != MUST_GO:
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            if (state, initial) in _GOES:
                ways.append((extra + behind[_GOES[state, initial]], KEEP))
            made = _MADE[state]
            if made != initial:
                ways.append((extra + REROLE_COST + behind[_GOES[state, made]], REROLE))
        costs.append(min(ways))
    # turns made up before the row; no cheapest way makes up more than there are states
    for _ in STATES:
        for state in STATES:
            costs[state] = min(costs[state], (INSERT_COST + costs[_GOES[state, _MADE[state]]][0], INSERT))
    for state in STATES:
        edits |= costs[state][1] << (2 * state)
    return tuple(c for c, _ in costs), edits


class _Backwards:
    """The program over rows from last to first, with remembered steps."""

    def __init__(self) -> None:
        self._known: dict = {}

    def step(self, behind: tuple, code: int) -> tuple[tuple, int, int]:
        """Costs before the row less their least, the least, and backpointers; ``behind``
        has 0 as its least cost."""
        found = self._known.get((behind, code))
        if found is None:
            costs, edits = _back_one(behind, code)
            least = min(costs)
            # what cannot be reached stays as far away as it is
            found = tuple(c if c >= _FAR else c - least for c in costs), least, edits
            found = tuple(min(c, _FAR) for c in found[0]), found[1], found[2]
            self._known[behind, code] = found
        return found

    def run(self, behind: tuple, codes: bytes) -> tuple[tuple, bytearray]:
        """Costs before all rows, and their backpointers in order."""
        base = min(behind)
        now = tuple(min(c, _FAR) if c >= _FAR else c - base for c in behind)
        pointers = bytearray(len(codes))
        for i in range(len(codes) - 1, -1, -1):
            now, more, pointers[i] = self.step(now, codes[i])
            base += more
        return tuple(c if c >= _FAR else c + base for c in now), pointers


def _moves(pointers: int, initial: int, state: int) -> tuple[str, int]:
    """The edits at a row that is met in ``state``, and the state behind it."""
    edits = ""
    while True:
        edit = pointers >> (2 * state) & 3
        edits += EDITS[edit]
        if edit == DELETE:
            return edits, state
        if edit == KEEP:
            return edits, _GOES[state, initial]
        state = _GOES[state, _MADE[state]]
        if edit == REROLE:
            return edits, state


class _Forwards:
    """Reads backpointers, with remembered moves."""

    def __init__(self) -> None:
        self._known: dict = {}

    def move(self, pointers: int, initial: int, state: int) -> tuple[str, int]:
        key = (pointers, initial, state)
        if key not in self._known:
            self._known[key] = _moves(*key)
        return self._known[key]

    def ends(self, pointers: bytes, codes: bytes) -> list[int]:
        """The state behind the piece, for every state before it."""
        now = list(STATES)
        for p, code in zip(pointers, codes):
            now = [self.move(p, code & 3, state)[1] for state in now]
        return now


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Rows of sorted Arrow batches, one at a time."""
    for frame in frames:
        yield from frame.itertuples(index=False, name=None)


def _frames(rows: Iterator[tuple], columns: list[str], size: int = 2048) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)


def _streamed(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df`` through ``fn``, an iterator of rows to an iterator of rows."""
    names = [c.split()[0] for c in schema.split(", ")]
    return df.mapInPandas(lambda frames: _frames(fn(_groups(frames)), names), schema)


_PIECE = "conv_key string, piece long, place long, codes binary, first_one int, last_one int, illegal long, ways array<long>"


def _pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``conv_key, piece, place, code`` from last to first become one row a piece.

    The program runs along, once for each state the piece may end in."""
    program, codes, key, now, base, low = _Backwards(), bytearray(), None, [], [], 0

    def done() -> tuple:
        ways = [c if c >= _FAR else c + b for v, b in zip(now, base) for c in v]
        in_order = bytes(reversed(codes))
        illegal = sum((a & 3, b & 3) not in _LEGAL for a, b in zip(in_order, in_order[1:]))
        return (*key, low, in_order, in_order[0] & 3, in_order[-1] & 3, illegal, ways)

    for conv, piece, place, code in rows:
        if (conv, piece) != key:
            if key is not None:
                yield done()
            key, codes, base = (conv, piece), bytearray(), [0] * len(STATES)
            now = [tuple(0 if s == end else _FAR for s in STATES) for end in STATES]
        codes.append(code)
        low = place
        for i, behind in enumerate(now):
            now[i], more, _ = program.step(behind, code)
            base[i] += more
    if key is not None:
        yield done()


_BEHIND = "conv_key string, piece long, behind array<long>, is_last boolean, cost long, illegal long"


def _costs_behind(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``conv_key, piece, first_one, last_one, illegal, ways`` from last to first: what
    the rows behind each piece cost; the first piece also has the totals."""
    conv, held, before, next_one, illegal = None, None, None, None, 0
    for key, piece, first_one, last_one, within, ways in rows:
        if key != conv:
            if held is not None:
                yield (*held, before[START], illegal)
            conv, before, next_one, illegal, held = key, _END, None, 0, None
        if held is not None:
            yield (*held, None, None)
        held = (key, piece, list(before), next_one is None)
        illegal += within + (next_one is not None and (last_one, next_one) not in _LEGAL)
        size = len(STATES)
        before = tuple(min(int(ways[end * size + s]) + before[end] for end in STATES) for s in STATES)
        next_one = first_one
    if held is not None:
        yield (*held, before[START], illegal)


_POINTERS = "conv_key string, piece long, place long, codes binary, pointers binary, ends array<int>, is_last boolean"


def _pointers(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The backpointers of a piece, and where they lead from each state."""
    back, forth = _Backwards(), _Forwards()
    for key, piece, place, codes, behind, is_last in rows:
        _, pointers = back.run(tuple(map(int, behind)), codes)
        yield key, piece, place, codes, bytes(pointers), forth.ends(pointers, codes), is_last


def _entered(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``conv_key, piece, ends`` from first to last: the state in which a piece is entered."""
    conv, state = None, START
    for key, piece, ends in rows:
        if key != conv:
            conv, state = key, START
        yield key, piece, state
        state = int(ends[state])


_EDITED = "conv_key string, piece long, place long, audit string, is_last boolean, state int"


def _audits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The edits of a piece, in order."""
    forth = _Forwards()
    for key, piece, place, codes, pointers, is_last, state in rows:
        entered, audit = state, []
        for p, code in zip(pointers, codes):
            edits, state = forth.move(p, code & 3, state)
            audit.append(edits)
        if is_last:
            audit.append(EDITS[INSERT] * _MISSING[state])
        yield key, piece, place, "".join(audit), is_last, entered


def _decisions(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``conv_key, place, codes, audit, state`` become the rows that stay or are made."""
    for key, place, codes, audit, state in rows:
        at, part = 0, 0
        for edit in audit:
            made = _MADE[state]
            if edit == EDITS[INSERT]:
                # behind the last row they keep its place
                behind = at >= len(codes)
                yield key, place + min(at, len(codes) - 1), part + behind * (_OWN_PART + 1), True, ROLE_NAMES[made]
                state, part = _GOES[state, made], part + 1
                continue
            if edit == EDITS[KEEP]:
                state = _GOES[state, codes[at] & 3]
                yield key, place + at, _OWN_PART, False, None
            elif edit == EDITS[REROLE]:
                state = _GOES[state, made]
                yield key, place + at, _OWN_PART, False, ROLE_NAMES[made]
            at, part = at + 1, 0


def _code() -> Column:
    fault = F.col("fault")
    kind = F.when(fault.isNull(), SOUND).when(fault == "truncated", TRUNCATED).otherwise(MUST_GO)
    number = F.lit(_OTHER)
    for i, name in enumerate(INITIALS):
        number = F.when(F.col("initial") == name, i).otherwise(number)
    return (4 * kind + number).cast("int")


def repair(rows: DataFrame, piece_bits: int = PIECE_BITS) -> Repaired:
    """The cheapest edits that make the turns of each conversation read ``(s?(ua)+)?``.

    ``rows`` are ``conv_key, turn, role, text`` (``conv_key`` never null).  A
    conversation is its rows by turn (null first), role and text.  Keeping a row costs
    0, giving it the role user or assistant 1, deleting it 2, making up an empty turn
    of user or assistant 5; a truncated row that stays costs 5 more; blank rows and
    those whose role and text stood earlier must go.  Of equally cheap repairs the one
    whose edits (``D I K R``, in order) are least in ASCII is taken.  A role counts by
    its first letter.

    ``report``: ``conv_key, blank, duplicate, truncated, illegal`` (adjacent initials
    other than ``su ua au``), ``gaps`` (turns missing between the least and the
    largest), ``cost, audit``.
    """
    placed = in_order(rows)
    faulty = written(with_faults(placed), "faults")
    piece = F.shiftright("place", piece_bits).alias("piece")
    coded = faulty.select("conv_key", piece, "place", _code().alias("code"))
    pieces = written(
        _streamed(
            coded.repartition("conv_key", "piece").sortWithinPartitions("conv_key", "piece", F.desc("place")),
            _pieces,
            _PIECE,
        ),
        "pieces",
    )
    narrow = pieces.select("conv_key", "piece", "first_one", "last_one", "illegal", "ways")
    behind = written(
        _streamed(
            narrow.repartition("conv_key").sortWithinPartitions("conv_key", F.desc("piece")), _costs_behind, _BEHIND
        ),
        "costs-behind",
    )
    pointers = written(
        _streamed(
            pieces.select("conv_key", "piece", "place", "codes")
            .join(behind.select("conv_key", "piece", "behind", "is_last"), ["conv_key", "piece"])
            .select("conv_key", "piece", "place", "codes", "behind", "is_last"),
            _pointers,
            _POINTERS,
        ),
        "backpointers",
    )
    entered = _streamed(
        pointers.select("conv_key", "piece", "ends").repartition("conv_key").sortWithinPartitions("conv_key", "piece"),
        _entered,
        "conv_key string, piece long, state int",
    )
    audits = written(
        _streamed(
            pointers.join(entered, ["conv_key", "piece"]).select(
                "conv_key", "piece", "place", "codes", "pointers", "is_last", "state"
            ),
            _audits,
            _EDITED,
        ),
        "audits",
    )
    return Repaired(_rows(placed, pieces, audits), _report(faulty, behind, audits))


def _rows(placed: DataFrame, pieces: DataFrame, audits: DataFrame) -> DataFrame:
    decided = _streamed(
        audits.drop("place").join(pieces.select("conv_key", "piece", "place", "codes"), ["conv_key", "piece"]).select(
            "conv_key", "place", "codes", "audit", "state"
        ),
        _decisions,
        "conv_key string, place long, part int, made boolean, new_role string",
    )
    decided = written(decided, "decisions")
    stay = (
        decided.filter(~F.col("made"))
        .select("place", "part", "new_role")
        .join(placed, "place")
        .select("conv_key", "place", "part", F.coalesce("new_role", "role").alias("role"), "text")
    )
    made = decided.filter("made").select(
        "conv_key", "place", "part", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    return stay.unionByName(made)


def _report(faulty: DataFrame, behind: DataFrame, audits: DataFrame) -> DataFrame:
    counts = faulty.groupBy("conv_key").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    wide = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count("turn")
    # turns once each first, so that a conversation is not one task's set
    turns = faulty.select("conv_key", "turn").distinct().groupBy("conv_key").agg(
        F.coalesce(wide, F.lit(0)).try_cast("long").alias("gaps")
    )
    totals = behind.filter(F.col("cost").isNotNull()).select("conv_key", "cost", "illegal")
    parts = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    joined = audits.groupBy("conv_key").agg(
        F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit")
    )
    return counts.join(turns, "conv_key").join(totals, "conv_key").join(joined, "conv_key")


def digests(rows: DataFrame) -> DataFrame:
    """``conv_key, sha256`` (lowercase hex) of ``role:text`` of the rows of each
    conversation in order, joined by line feeds; rows are streamed."""

    def run(ordered: Iterator[tuple]) -> Iterator[tuple]:
        conv, hasher = None, None
        for key, role, text in ordered:
            if key != conv:
                if hasher is not None:
                    yield conv, hasher.hexdigest()
                conv, hasher = key, hashlib.sha256()
            else:
                hasher.update(b"\n")
            hasher.update(f"{role}:{text}".encode())
        if hasher is not None:
            yield conv, hasher.hexdigest()

    ordered = rows.repartition("conv_key").sortWithinPartitions("conv_key", "place", "part")
    return _streamed(ordered.select("conv_key", "role", "text"), run, "conv_key string, sha256 string")
