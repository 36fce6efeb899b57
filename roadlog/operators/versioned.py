"""Bulk actions that only apply to the version of a document their sender has seen.

Documents carry ``_version`` (counted up by every write, or given from outside) and
``_seq_no, _primary_term`` (the last write that changed them).  An action may ask for the
write it expects to be the last (``if_seq_no``, ``if_primary_term``) or bring a version of
its own (``version`` with ``version_type`` ``external`` or ``external_gte``).

Whether an action is accepted depends on those before it, so a document's actions form
a chain.  Documents with no more actions than a block has places are gone through action
by action, one document behind the other in a task.  The actions of the others, which are
few, are cut into blocks of consecutive places.  What a block does is summed
up as a function of the state it is entered with: which writes pass if the document is
there or not, if its last write is one the block names, if its version is below the
largest that the block brings.  One row a block is then folded in order, which tells the
state before every block, and the blocks are gone through with it side by side.  So a
document with a third of all actions is folded block by block and not action by action
(blocks that mix own and external versions are handed to the fold as they are).
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.operators import keyed
from roadlog.operators.keyed import KEY
from roadlog.operators.ordered import BLOCK_BITS
from roadlog.workspace import written

STATE = ("_version", "_seq_no", "_primary_term")
CONDITIONS = ("if_seq_no", "if_primary_term", "version", "version_type", "retry_on_conflict")

# operations and conditions as numbers
_INDEX, _CREATE, _UPDATE, _DELETE, _UNUSABLE = range(5)
_OPS = {"index": _INDEX, "create": _CREATE, "update": _UPDATE, "delete": _DELETE}
_FREE, _EXPECTS, _EXTERNAL, _EXTERNAL_GTE = range(4)

# version and numbers of a document that was never there
_NEVER = (0, -1, -1, -1)


class Action(NamedTuple):
    """What decides about an action; ``number`` and ``term`` go with ``_EXPECTS``,
    ``number`` is the version for external ones."""

    place: int
    op: int
    condition: int
    number: int
    term: int


def with_conditions(expanded: DataFrame) -> DataFrame:
    """``seq, op, _index, _id, source`` and the conditions that the action lines of
    :func:`roadlog.operators.documents.expand_actions` carry."""
    kinds = "if_seq_no bigint, if_primary_term bigint, version bigint, version_type string, retry_on_conflict bigint"
    meta = F.try_element_at(F.from_json("action_line", f"map<string,struct<{kinds}>>"), F.col("op"))
    return expanded.withColumn("_meta", meta).select(
        "seq", "op", *KEY, F.col("source_line").alias("source"), *[F.col(f"_meta.{c}").alias(c) for c in CONDITIONS]
    )


def _conditions_hold_together(op: Column, named: Column) -> Column:
    """Whether the conditions of an action can be asked for at all."""
    seq_no, term, version, kind, retries = map(F.col, CONDITIONS)
    expects = seq_no.isNotNull() | term.isNotNull()
    both = seq_no.isNotNull() & term.isNotNull() & version.isNull() & (op != "create") & named
    both &= ~((op == "update") & (F.coalesce(retries, F.lit(0)) > 0))
    external = F.lower(F.coalesce(kind, F.lit("internal"))).isin("external", "external_gte")
    given = external & op.isin("index", "delete") & named & (version >= 0)
    return F.when(expects, both).when(version.isNotNull(), given).otherwise(~external)


# --- the state of a document --------------------------------------------------


def _step(state: tuple, a: Action, first: int, term: int) -> tuple[int, tuple]:
    """Status of an action, and the state ``(present, version, seq_no, term)`` after it."""
    present, version, seq_no, own_term = state
    if a.op == _UNUSABLE:
        return 400, state
    if a.condition == _EXPECTS:
        if not present or (seq_no, own_term) != (a.number, a.term):
            return 409, state
    elif a.condition != _FREE:
        if not (a.number > version or a.condition == _EXTERNAL_GTE and a.number == version):
            return 409, state
    elif a.op == _CREATE and present:
        return 409, state
    elif a.op in (_UPDATE, _DELETE) and not present:
        return 404, state
    status = 200 if present else 404 if a.op == _DELETE else 201
    after = a.number if a.condition in (_EXTERNAL, _EXTERNAL_GTE) else max(version, 0) + 1
    return status, (int(a.op != _DELETE), after, first + a.place, term)


def _own_versions(actions: list[Action], first: int, term: int) -> dict:
    """What a block without external versions makes of a state.

    Writes that are accepted form chains: after one, the next is the first that the
    state it leaves lets through, whatever came before.
    """
    n = len(actions)
    expected: dict[tuple, list[int]] = {}
    for i, a in enumerate(actions):
        if a.condition == _EXPECTS and a.op != _UNUSABLE:
            expected.setdefault((a.number, a.term), []).append(i)
    # next write that passes on any document, on one that is not there, on one that is
    nearest = [n, n, n]
    ends: list[tuple[int, int]] = [(0, 0)] * n  # the last write of the chain, and its length
    after = [None] * n
    for i in range(n - 1, -1, -1):
        a = actions[i]
        after[i] = list(nearest)
        if a.op == _UNUSABLE:
            continue
        there = int(a.op != _DELETE)
        following = min(nearest[0], nearest[1 + there])
        if there:
            same = expected.get((first + a.place, term), [])
            at = bisect.bisect_right(same, i)
            if at < len(same):
                following = min(following, same[at])
        ends[i] = (i, 1) if following == n else (ends[following][0], ends[following][1] + 1)
        if a.condition == _FREE:
            nearest[{_INDEX: 0, _CREATE: 1, _UPDATE: 2, _DELETE: 2}[a.op]] = i

    def outcome(i: int) -> list | None:
        if i == n:
            return None
        last, length = ends[i]
        return [int(actions[last].op != _DELETE), first + actions[last].place, length]

    absent, present = min(nearest[0], nearest[1]), min(nearest[0], nearest[2])
    known = [
        [number, of_term, outcome(where[0])] for (number, of_term), where in expected.items() if where[0] < present
    ]
    return {"own": [outcome(absent), outcome(present)], "known": known}


def _external_versions(actions: list[Action], first: int) -> dict:
    """What a block of external versions alone makes of a state: nothing if the version
    there is larger than all it brings."""
    usable = [a for a in actions if a.op != _UNUSABLE]
    largest = max((a.number for a in usable), default=-1)
    at_largest = [a for a in usable if a.number == largest]
    # the first to bring it, then those that may repeat it
    below = at_largest[:1] + [a for a in at_largest[1:] if a.condition == _EXTERNAL_GTE]
    equal = [a for a in at_largest if a.condition == _EXTERNAL_GTE]
    last = [[int(x[-1].op != _DELETE), first + x[-1].place] if x else None for x in (below, equal)]
    return {"largest": largest, "below": last[0], "equal": last[1]}


def _summary(actions: list[Action], first: int, term: int) -> dict | None:
    kinds = {a.condition >= _EXTERNAL for a in actions if a.op != _UNUSABLE}
    if kinds == {True}:
        return _external_versions(actions, first)
    return None if len(kinds) == 2 else _own_versions(actions, first, term)


def _after(state: tuple, does: dict, term: int) -> tuple:
    """The state behind a block."""
    present, version, seq_no, own_term = state
    if "largest" in does:
        largest = does["largest"]
        last = does["below"] if version < largest else does["equal"] if version == largest else None
        return (last[0], largest, last[1], term) if last else state
    found = does["own"][present]
    if present:
        found = next((r for number, t, r in does["known"] if (number, t) == (seq_no, own_term)), found)
    return (found[0], max(version, 0) + found[2], found[1], term) if found else state


# --- documents with few actions -----------------------------------------------

_STATUS = "_place long, _index string, _id string, op int, status int, _version long, _seq_no long"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _statuses_in_order(coded: DataFrame, there: DataFrame, first: int, term: int) -> DataFrame:
    """The status of every action, each document gone through from its first action to
    its last."""
    # what a document starts from comes before its first action
    starts = there.select(
        *KEY,
        F.lit(-1).cast("long").alias("place"),
        F.lit(_INDEX).alias("op"),
        F.lit(_FREE).alias("condition"),
        F.col("_seq_no").alias("number"),
        F.col("_primary_term").alias("term"),
        "_version",
    )
    rows = coded.drop("block").withColumn("_version", F.lit(0).cast("long")).unionByName(starts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, _NEVER
        for frame in frames:
            # column by column: a row as a tuple costs more than the step it takes
            statuses, versions, numbers = [], [], []
            for index, name, place, op, condition, number, own_term, version in zip(
                *[frame[c].tolist() for c in frame.columns]
            ):
                if (index, name) != key:
                    key, state = (index, name), _NEVER
                if place < 0:
                    state = (1, version, number, own_term)
                    continue
                status, state = _step(state, Action(place, op, condition, number, own_term), first, term)
                statuses.append(status)
                versions.append(max(state[1], 0))
                numbers.append(state[2])
            if statuses:
                out = frame.loc[frame["place"] >= 0, ["place", *KEY, "op"]].rename(columns={"place": "_place"})
                yield out.assign(status=statuses, _version=versions, _seq_no=numbers)

    ordered = rows.repartition(*KEY).sortWithinPartitions(*KEY, "place")
    return ordered.select(*KEY, *Action._fields, "_version").mapInPandas(run, _STATUS)


# --- blocks as rows -----------------------------------------------------------

_PACKED = "place array<long>, op array<int>, condition array<int>, number array<long>, term array<long>"
_BLOCK = f"_index string, _id string, block long, does string, {_PACKED}"
_ENTERED = "_index string, _id string, block long, state array<long>"
# a task hands on so many actions at once, or one block
_AT_ONCE = 1 << 14


def _actions_of(row: Sequence) -> list[Action]:
    return [Action(*map(int, x)) for x in zip(*row)]


def _blocks(coded: DataFrame, first: int, term: int) -> DataFrame:
    """The actions of a document and block in one row, with what they do."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out, n = None, [], [], 0

        def done() -> tuple:
            does = _summary(held, first, term)
            return (*key, None if does is None else json.dumps(does), *map(list, zip(*held)))

        for frame in frames:
            for index, name, block, *action in frame.itertuples(index=False, name=None):
                if (index, name, block) != key:
                    if held:
                        out.append(done())
                        n += len(held)
                    if n >= _AT_ONCE:
                        yield _frame(out, _BLOCK)
                        out, n = [], 0
                    key, held = (index, name, block), []
                held.append(Action(*action))
        if held:
            out.append(done())
        if out:
            yield _frame(out, _BLOCK)

    ordered = coded.repartition(*KEY, "block").sortWithinPartitions(*KEY, "block", "place")
    return ordered.select(*KEY, "block", *Action._fields).mapInPandas(pack, _BLOCK)


def _states_before(blocks: DataFrame, there: DataFrame, first: int, term: int) -> DataFrame:
    """The state before each block, folded along each document's blocks; only blocks
    that have no summary bring their actions along."""
    mixed = F.col("does").isNull()
    narrow = blocks.select(*KEY, "block", "does", *[F.when(mixed, F.col(c)).alias(c) for c in Action._fields])
    starts = there.select(
        *KEY, F.lit(-1).cast("long").alias("block"),
        F.array(F.lit(1).cast("long"), *[F.col(c) for c in STATE]).alias("start"),
    )
    rows = narrow.unionByName(starts, allowMissingColumns=True)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, _NEVER
        for frame in frames:
            out = []
            for index, name, block, does, *packed, start in frame.itertuples(index=False, name=None):
                if (index, name) != key:
                    key, state = (index, name), _NEVER
                if start is not None:
                    state = tuple(map(int, start))
                    continue
                out.append((index, name, block, list(state)))
                if does is not None:
                    state = _after(state, json.loads(does), term)
                else:
                    for a in _actions_of(packed):
                        _, state = _step(state, a, first, term)
            if out:
                yield _frame(out, _ENTERED)

    ordered = rows.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return ordered.select(*KEY, "block", "does", *Action._fields, "start").mapInPandas(fold, _ENTERED)


def _statuses(blocks: DataFrame, entered: DataFrame, first: int, term: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for frame in frames:
            for index, name, state, *packed in frame.itertuples(index=False, name=None):
                state = tuple(map(int, state))
                for a in _actions_of(packed):
                    status, state = _step(state, a, first, term)
                    out.append((a.place, index, name, a.op, status, max(state[1], 0), state[2]))
                if len(out) >= _AT_ONCE:
                    yield _frame(out, _STATUS)
                    out = []
        if out:
            yield _frame(out, _STATUS)

    rows = blocks.drop("does").join(entered, [*KEY, "block"])
    return rows.select(*KEY, "state", *Action._fields).mapInPandas(run, _STATUS)


# --- applying -----------------------------------------------------------------


def _versioned_documents(df: DataFrame) -> DataFrame:
    known = {"_version": F.lit(1), "_seq_no": F.lit(-1), "_primary_term": F.lit(-1)}
    own = [
        F.coalesce(F.col(c).cast("long") if c in df.columns else F.lit(None), v).cast("long").alias(c)
        for c, v in known.items()
    ]
    return keyed._documents(df, *own)


def apply_versioned(
    target: DataFrame,
    actions: DataFrame,
    order: Sequence[str] = ("seq",),
    primary_term: int = 1,
    id_prefix: str | None = None,
    block_bits: int = BLOCK_BITS,
) -> keyed.Applied:
    """Like :func:`roadlog.operators.keyed.apply_actions`, with versions.

    ``target`` may have ``_version`` (else 1), ``_seq_no`` and ``_primary_term`` (else
    unknown, which no action can expect); ``actions`` may have the columns of
    ``CONDITIONS``.  The action at place ``p`` of the order, if it is accepted, has the
    sequence number ``p`` plus one more than the largest of the target; numbers of refused actions are
    not used again.  Every accepted write counts the version up by one or sets the
    external one.

    409: the last write is not the expected one, or the external version is not larger
    (``external_gte``: smaller) than the one there; a deleted document remembers its
    version through the actions.  An external version on a delete of what is not there
    is remembered too (404).  400, besides what is no usable action: ``if_seq_no`` without
    ``if_primary_term`` or the other way, either of them with ``create``, with a version
    or with retries of an update; a version that is not external, or with ``create`` or
    ``update``; conditions without an id.  ``retry_on_conflict`` alone changes nothing, for nobody
    else writes between the actions.

    The table has ``_version, _seq_no, _primary_term`` of every document (-1: unknown);
    results have ``_version`` and ``_seq_no`` after the action.
    """
    missing = {c: F.lit(None).cast("string" if c == "version_type" else "long") for c in CONDITIONS if c not in actions.columns}
    before = _versioned_documents(target)
    first = max(before.agg(F.max("_seq_no")).first()[0] or 0, -1) + 1
    acts = keyed._numbered_actions(actions.withColumns(missing), order, id_prefix, CONDITIONS)
    coded = _coded(acts, block_bits)
    counted = written(coded.groupBy(*KEY).agg(F.count("*").alias("n")), "action-counts")
    there = before.drop("source").join(counted, list(KEY), "left_semi")
    # each has more actions than a block has places, so there are fewer than blocks
    long = F.broadcast(counted.filter(F.col("n") > 1 << block_bits).select(*KEY))
    if long.isEmpty():
        scored = _statuses_in_order(coded, there, first, primary_term)
    else:
        scored = _statuses_in_order(
            coded.join(long, list(KEY), "left_anti"), there.join(long, list(KEY), "left_anti"), first, primary_term
        )
        blocks = written(_blocks(coded.join(long, list(KEY), "left_semi"), first, primary_term), "action-blocks")
        entered = _states_before(blocks, there.join(long, list(KEY), "left_semi"), first, primary_term)
        scored = scored.unionByName(_statuses(blocks, entered, first, primary_term))
    scored = written(scored, "versioned-statuses")
    table = _documents_after(before, acts, scored, primary_term)
    return keyed.Applied(
        keyed._shaped(table, target, actions), keyed._shaped(_results(acts, scored), target, actions)
    )


def _coded(acts: DataFrame, block_bits: int) -> DataFrame:
    """``*KEY, block`` and the fields of :class:`Action`."""
    holds = F.coalesce(F.col("_usable") & _conditions_hold_together(F.col("op"), F.col("_named")), F.lit(False))
    op = F.lit(_UNUSABLE)
    for name, code in _OPS.items():
        op = F.when(F.col("op") == name, code).otherwise(op)
    # an id that was made up must not meet a document
    op = F.when(~holds, _UNUSABLE).when(~F.col("_named") & (op == _INDEX), _CREATE).otherwise(op)
    kind = F.lower("version_type")
    condition = (
        F.when(F.col("if_seq_no").isNotNull(), _EXPECTS)
        .when(F.col("version").isNull(), _FREE)
        .otherwise(F.when(kind == "external_gte", _EXTERNAL_GTE).otherwise(_EXTERNAL))
    )
    return acts.select(
        *KEY,
        F.shiftright("_place", block_bits).alias("block"),
        F.col("_place").alias("place"),
        op.cast("int").alias("op"),
        condition.cast("int").alias("condition"),
        F.coalesce("if_seq_no", "version", F.lit(0)).cast("long").alias("number"),
        F.coalesce("if_primary_term", F.lit(0)).cast("long").alias("term"),
    )


def _documents_after(before: DataFrame, acts: DataFrame, scored: DataFrame, term: int) -> DataFrame:
    """Documents that nothing changed pass through; the others get the numbers of their
    last write."""
    op = F.lit(None).cast("string")
    for name, code in _OPS.items():
        op = F.when(F.col("op") == code, name).otherwise(op)
    done = scored.filter(F.col("status") < 300).withColumn("op", op)
    last = written(
        done.groupBy(*KEY).agg(
            F.max_by("_version", "_place").alias("_version"), F.max("_seq_no").alias("_seq_no"), keyed._base()
        ),
        "last-writes",
    )
    names = last.select(*KEY)
    if keyed._are_few(names):
        names = F.broadcast(names)
    named = before.select(*KEY, "source").join(names, list(KEY), "left_semi")
    bases, last = last.select(*KEY, "_base"), last.drop("_base")
    changed = keyed._final_documents(named, acts, done.select("_place", "op", *KEY, "status"), bases)
    numbered = changed.join(last, list(KEY)).withColumn("_primary_term", F.lit(term).cast("long"))
    return before.join(names, list(KEY), "left_anti").unionByName(numbered)


def _results(acts: DataFrame, scored: DataFrame) -> DataFrame:
    ok = F.col("status").between(200, 299)
    return acts.join(scored.drop(*KEY, "op"), "_place").select(
        *(["seq"] if "seq" in acts.columns else [F.col("_place").alias("seq")]),
        "op",
        *KEY,
        "status",
        ok.alias("ok"),
        keyed.error_name(F.col("status")).alias("error"),
        "_version",
        "_seq_no",
        F.when(~ok, F.col("source")).alias("source"),
    )
