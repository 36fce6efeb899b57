"""Chunks of bulk actions.

:func:`chunk_stream` cuts the whole order greedily, as one sender would.  Where a
chunk ends follows from where it starts, so the order is cut into blocks, and a block
is a function from the place of its first start to that of the next block's.  Blocks
find their functions side by side; composing them, a row a block, tells where each
begins; then they are cut side by side.

:func:`chunk_actions` and :func:`chunk_payloads` need no such order: they cut lanes,
``seq >> lane_bits``, so a lane holds at most ``2**lane_bits`` consecutive actions
whatever their ids are.  Chunks are cut greedily inside a lane; lanes are independent
of each other.  The same input always gives the same chunks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlog.operators.ordered import positions
from roadlog.workspace import written

# Default limits of a chunk.
CHUNK_SIZE = 500
MAX_CHUNK_BYTES = 100 * 1024 * 1024


def action_bytes() -> Column:
    """UTF-8 size of an action as sent, with one line feed per line."""
    return (
        F.octet_length("action_line")
        + 1
        + F.coalesce(F.octet_length("source_line") + 1, F.lit(0))
    ).cast("long")


def chunk_bounds(sizes: np.ndarray, size: int, max_bytes: int) -> list[int]:
    """Starts of greedy chunks over consecutive action sizes.

    A chunk ends at ``size`` actions or before the action that would take it
    over ``max_bytes``; an action above the limit is a chunk of its own.
    """
    ends = np.cumsum(sizes)
    starts, at, n = [], 0, len(sizes)
    while at < n:
        starts.append(at)
        used = ends[at - 1] if at else 0
        fitting = int(np.searchsorted(ends, used + max_bytes, side="right"))
        at = min(max(fitting, at + 1), at + size)
    return starts


def _in_lanes(df: DataFrame, lane_bits: int, partitions: int | None) -> DataFrame:
    laned = df.withColumn("lane", F.shiftright("seq", lane_bits))
    by_lane = laned.repartition(partitions, "lane") if partitions else laned.repartition("lane")
    return by_lane.sortWithinPartitions("lane", "seq")


def _numbered(batches: Iterable[pd.DataFrame], size: int, max_bytes: int) -> Iterator[pd.DataFrame]:
    """Add ``chunk`` to sorted batches of a partition; every frame holds whole chunks.

    At most one batch and one unfinished chunk are in memory.
    """
    held: pd.DataFrame | None = None
    number = 0  # of the held chunk in its lane
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        cuts = np.flatnonzero(np.diff(rows["lane"].to_numpy())) + 1
        edges = [0, *cuts.tolist(), len(rows)]
        sizes = rows["bytes"].to_numpy()
        numbers = np.empty(len(rows), dtype=np.int64)
        for a, b in zip(edges, edges[1:]):
            starts = chunk_bounds(sizes[a:b], size, max_bytes)
            numbers[a:b] = number + np.searchsorted(starts, np.arange(b - a), side="right") - 1
            number = number + len(starts) - 1 if b == len(rows) else 0
        # the last chunk may still grow
        done = a + starts[-1]
        held = rows.iloc[done:]
        if done:
            yield rows.iloc[:done].assign(chunk=numbers[:done])
    if held is not None:
        yield held.assign(chunk=number)


def chunk_actions(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    max_bytes: int = MAX_CHUNK_BYTES,
    lane_bits: int = 16,
    partitions: int | None = None,
) -> DataFrame:
    """``(lane, chunk, seq, bytes)`` per action of an expanded action frame.

    Only the sizes travel to Python; join back on ``seq`` for the lines.
    """

    def cut(batches):
        for rows in _numbered(batches, size, max_bytes):
            yield rows[["lane", "chunk", "seq", "bytes"]]

    sizes = df.select("seq", action_bytes().alias("bytes"))
    return _in_lanes(sizes, lane_bits, partitions).mapInPandas(
        cut, "lane long, chunk long, seq long, bytes long"
    )


def chunk_by_count(df: DataFrame, order: str = "seq", size: int = CHUNK_SIZE) -> DataFrame:
    """Add ``chunk``: the chunk of each row when only the count limits a chunk.

    Chunks run over the whole table in ``order``.
    """
    ranked = positions(df, [order], "_rank")
    return ranked.withColumn("chunk", F.floor(F.col("_rank") / size)).drop("_rank")


def chunk_payloads(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    max_bytes: int = MAX_CHUNK_BYTES,
    lane_bits: int = 16,
    partitions: int | None = None,
) -> DataFrame:
    """``(lane, chunk, n, bytes, payload)``: the request body of each chunk.

    Every line ends in a line feed.  A sender is ``foreachPartition`` over the
    result; a task that runs again sends again, so actions should carry ids.
    """

    def bodies(batches):
        for rows in _numbered(batches, size, max_bytes):
            rows["_text"] = rows["action_line"] + "\n" + (rows["source_line"] + "\n").fillna("")
            chunks = rows.groupby(["lane", "chunk"], sort=False)
            yield chunks.agg(n=("seq", "size"), bytes=("bytes", "sum"), payload=("_text", "".join)).reset_index()

    sized = df.select("seq", "action_line", "source_line", action_bytes().alias("bytes"))
    return _in_lanes(sized, lane_bits, partitions).mapInPandas(
        bodies, "lane long, chunk long, n long, bytes long, payload string"
    )


# --- one order, many tasks ----------------------------------------------------

# blocks whose functions are composed before the fold over all of them
_GROUP_BITS = 10
_CUT = "block long, seqs array<long>, sizes array<long>, exits array<int>, starts array<long>"


def _next_starts(sizes: np.ndarray, n: int, size: int, max_bytes: int) -> np.ndarray:
    """Where the chunk after the one that starts at each of the first ``n`` actions starts."""
    ends = np.cumsum(sizes)
    before = ends[:n] - sizes[:n]
    at = np.arange(n)
    fitting = np.searchsorted(ends, before + max_bytes, side="right")
    return np.minimum(np.maximum(fitting, at + 1), at + size)


def _through(following: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every place of a first start: that in the next block, and the starts between.

    Starts are followed in leaps that double.
    """
    after = np.concatenate([following, np.arange(n, n + size + 1)])
    passed = np.concatenate([np.ones(n, np.int64), np.zeros(size + 1, np.int64)])
    while (after[:size] < n).any():
        passed = passed + passed[after]
        after = after[after]
    return after[:size] - n, passed[:size]


def _blocks(df: DataFrame, size: int, max_bytes: int, bits: int) -> DataFrame:
    """A row a block: its actions in order, and its function."""
    n = 1 << bits
    placed = positions(df, ["seq"], "place").select(
        "seq", "bytes", F.shiftright("place", bits).alias("block"), F.col("place").bitwiseAND(n - 1).alias("at")
    )
    # a chunk may reach into the next block
    reach = placed.filter((F.col("at") < size) & (F.col("block") > 0)).select(
        "seq", "bytes", (F.col("block") - 1).alias("block"), (F.col("at") + n).alias("at")
    )

    def function(block: int, rows: pd.DataFrame) -> tuple:
        own = int((rows["at"] < n).sum())
        sizes = rows["bytes"].to_numpy()
        following = _next_starts(sizes, own, size, max_bytes)
        exits, starts = _through(following, own, size)
        return block, rows["seq"].to_numpy()[:own], sizes, exits.astype(np.int32), starts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        names = [c.split()[0] for c in _CUT.split(", ")]
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            edges = [0, *(np.flatnonzero(np.diff(rows["block"].to_numpy())) + 1).tolist(), len(rows)]
            for a, b in zip(edges, edges[1:-1]):
                yield pd.DataFrame([function(int(rows["block"].iloc[a]), rows.iloc[a:b])], columns=names)
            held = rows.iloc[edges[-2] :]
        if held is not None and len(held):
            yield pd.DataFrame([function(int(held["block"].iloc[0]), held)], columns=names)

    dealt = placed.unionByName(reach).repartition("block").sortWithinPartitions("block", "at")
    return dealt.select("block", "at", "seq", "bytes").mapInPandas(run, _CUT)


_FUNCTION = "block long, exits array<int>, starts array<long>"


def _composed(functions: DataFrame) -> DataFrame:
    """The functions of groups of ``2**_GROUP_BITS`` blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, exits, starts = None, None, None
        for batch in batches:
            for block, own_exits, own_starts in batch.itertuples(index=False, name=None):
                if block >> _GROUP_BITS != group:
                    if group is not None:
                        yield pd.DataFrame([(group, exits, starts)], columns=["block", "exits", "starts"])
                    group, exits, starts = block >> _GROUP_BITS, own_exits, own_starts
                else:
                    starts = starts + own_starts[exits]
                    exits = own_exits[exits]
        if group is not None:
            yield pd.DataFrame([(group, exits, starts)], columns=["block", "exits", "starts"])

    by_group = functions.withColumn("_group", F.shiftright("block", _GROUP_BITS)).repartition("_group")
    return by_group.sortWithinPartitions("block").select("block", "exits", "starts").mapInPandas(run, _FUNCTION)


def _entered(functions: DataFrame, begun: DataFrame | None) -> DataFrame:
    """``block, entry, chunks``: where each block has its first start, and how many chunks
    started before; ``begun`` has the same of the groups (none: one order of all rows)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, entry, chunks = None, 0, 0
        for batch in batches:
            out = []
            for own_group, block, exits, starts, at, before in batch.itertuples(index=False, name=None):
                if own_group != group:
                    group, entry, chunks = own_group, int(at), int(before)
                out.append((block, entry, chunks))
                chunks, entry = chunks + int(starts[entry]), int(exits[entry])
            if out:
                yield pd.DataFrame(out, columns=["block", "entry", "chunks"])

    zero = F.lit(0).cast("long")
    if begun is None:
        rows = functions.select(zero.alias("_group"), "*", zero.alias("_at"), zero.alias("_before")).repartition(1)
    else:
        groups = begun.select(F.col("block").alias("_group"), F.col("entry").alias("_at"), F.col("chunks").alias("_before"))
        own = functions.withColumn("_group", F.shiftright("block", _GROUP_BITS))
        rows = own.join(groups, "_group").repartition("_group")
    ordered = rows.sortWithinPartitions("_group", "block")
    return ordered.select("_group", "block", "exits", "starts", "_at", "_before").mapInPandas(
        run, "block long, entry long, chunks long"
    )


def chunk_stream(
    df: DataFrame, size: int = CHUNK_SIZE, max_bytes: int = MAX_CHUNK_BYTES, block_bits: int = 16
) -> DataFrame:
    """``(chunk, seq, bytes)`` per action of an expanded action frame.

    Chunks are cut over the whole order of ``seq`` and numbered from 0: a chunk ends at
    ``size`` actions or before the action that would take it over ``max_bytes``; an
    action above the limit is a chunk of its own.  No task holds more than a block of
    ``2**block_bits`` actions (at least ``size``), and only numbers travel to Python;
    join back on ``seq`` for the lines, or use :func:`stream_bodies`.
    """
    bits = max(block_bits, (size - 1).bit_length())
    n = 1 << bits
    sizes = df.select(F.col("seq").cast("long").alias("seq"), action_bytes().alias("bytes"))
    blocks = written(_blocks(sizes, size, max_bytes, bits), "chunk-blocks")
    functions = blocks.select("block", "exits", "starts")
    groups = _entered(_composed(functions), None)
    entered = _entered(functions, groups)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for seqs, sizes_, entry, chunks in batch.itertuples(index=False, name=None):
                own = len(seqs)
                following = _next_starts(sizes_, own, size, max_bytes)
                starts, at = [], entry
                while at < own:
                    starts.append(at)
                    at = int(following[at])
                # what stands before the first start belongs to the chunk before
                number = chunks - 1 + np.searchsorted(starts, np.arange(own), side="right")
                yield pd.DataFrame({"chunk": number, "seq": seqs, "bytes": sizes_[:own]})

    joined = blocks.select("block", "seqs", "sizes").join(entered, "block")
    return joined.select("seqs", "sizes", "entry", "chunks").mapInPandas(cut, "chunk long, seq long, bytes long")


def stream_bodies(
    df: DataFrame, size: int = CHUNK_SIZE, max_bytes: int = MAX_CHUNK_BYTES, block_bits: int = 16
) -> DataFrame:
    """``(chunk, n, bytes, payload)``: the request bodies of :func:`chunk_stream`; ``seq`` must be unique.

    A group is one chunk, so its size is bounded by the limits.
    """
    text = F.concat_ws("\n", "action_line", "source_line", F.lit(""))
    lines = chunk_stream(df, size, max_bytes, block_bits).join(df.select("seq", text.alias("_text")), "seq")
    in_order = F.array_sort(F.collect_list(F.struct("seq", "_text")))
    return lines.groupBy("chunk").agg(
        F.count("*").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.array_join(F.transform(in_order, lambda x: x["_text"]), "").alias("payload"),
    )
