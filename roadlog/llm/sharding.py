"""Shards that follow a Hilbert curve through the metadata of the rows.

Each dimension is quantised to ``2**bits`` steps by quantiles: a number by its value, a
text by its place in the order of all texts, so least and largest value of a shard say
what is in it.  The curve visits the cells of that grid so that neighbours on
the curve are neighbours in all dimensions; rows sorted by the curve and cut into
runs of equal length give shards that are narrow in every dimension, so a reader
that filters on any of them skips most shards (``shard_bounds``).

The place of a row on the curve is found without a global sort.  Rows are
counted by cell (at most ``2**(bits * dimensions)`` of them; Spark broadcasts the cells
where they are small), a cell with many rows is cut into blocks by a hash
of the row, and rows are numbered inside their block; running sums over cells and
over the blocks of a cell give the number before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlog.llm.common import let, utf8_size
from roadlog.operators.ordered import positions
from roadlog.workspace import written

# rows numbered by one window, about
BLOCK = 4096


def hilbert_index(steps: Column, bits: int, dimensions: int) -> Column:
    """Index along the curve of a cell given as an array of whole numbers below ``2**bits``."""
    moves = F.array(
        *[
            F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(dimensions)
        ]
    )

    def move(x: Column, m: Column) -> Column:
        low = m["q"] - 1
        swap = F.get(x, F.lit(0)).bitwiseXOR(F.get(x, m["i"])).bitwiseAND(low)
        return F.when(
            F.get(x, m["i"]).bitwiseAND(m["q"]) != 0,
            F.transform(x, lambda v, k: F.when(k == 0, v.bitwiseXOR(low)).otherwise(v)),
        ).otherwise(
            F.transform(x, lambda v, k: F.when((k == 0) | (k == m["i"]), v.bitwiseXOR(swap)).otherwise(v))
        )

    places = F.array(
        *[
            F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"))
            for b in range(bits - 1, -1, -1)
            for i in range(dimensions)
        ]
    )
    lower = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)] or [F.lit(0)])

    def gray_code(x: Column) -> Column:
        return F.transform(
            x, lambda _, k: F.aggregate(F.slice(x, 1, k + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v))
        )

    def flip(x: Column) -> Column:
        last = F.get(x, F.lit(dimensions - 1))
        return F.aggregate(
            lower,
            F.lit(0),
            lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a),
        )

    def interleaved(x: Column) -> Column:
        return F.aggregate(
            places,
            F.lit(0).cast("long"),
            lambda a, p: a * 2 + F.pmod(F.call_function("shiftright", F.get(x, p["i"]), p["b"]), F.lit(2)),
        )

    turned = F.aggregate(moves, steps, move) if bits > 1 else steps
    return let(
        turned,
        lambda t: let(
            gray_code(t),
            lambda g: let(
                flip(g), lambda f: let(F.transform(g, lambda v: v.bitwiseXOR(f)), interleaved)
            ),
        ),
    )


def text_cuts(rows: DataFrame, name: str, steps: int) -> list[tuple[str, int]]:
    """The first text of each step but the lowest, with the step, when the rows are dealt evenly into
    ``steps`` along the order of the column; a text is in one step whole.

    Texts are counted, placed in order, and their counts summed by blocks of places
    and inside the blocks, so any number of distinct texts will do.
    """
    counted = rows.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    placed = positions(counted, ["value"], "place").withColumn("block", F.shiftright("place", 16))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("block")
        .agg(F.sum("n").alias("in_block"))
        .select(
            "block",
            F.coalesce(F.sum("in_block").over(earlier), F.lit(0)).alias("before"),
            F.sum("in_block").over(Window.partitionBy(F.lit(0))).alias("total"),
        )
    )
    within = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))
    stepped = (
        placed.join(blocks, "block")
        .withColumn("upto", before)
        .selectExpr("value", f"CAST((upto * {steps}) DIV total AS INT) AS step")
    )
    # at most a text a step; steps that a frequent text spans have none
    firsts = stepped.groupBy("step").agg(F.min("value").alias("value")).collect()
    return sorted((r.value, r.step) for r in firsts if r.step)


def quantised(rows: DataFrame, numbers: Sequence[str], words: Sequence[str], bits: int) -> list[Column]:
    """A step below ``2**bits`` for each named column; null is step 0."""
    steps = 1 << bits
    shares = [i / steps for i in range(1, steps)]
    # steps - 1 cut points for each column
    cuts = rows.agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in numbers]).first() if numbers else {}
    out = []
    for name in numbers:
        edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts[name] or []))])
        out.append(F.coalesce(F.size(F.filter(edges, lambda e: e < F.col(name))), F.lit(0)))
    for name in words:
        step = F.lit(0)
        for value, number in text_cuts(rows, name, steps):
            step = F.when(F.col(name) >= value, number).otherwise(step)
        out.append(step)
    return out


def assign(
    docs: DataFrame,
    shards: int = 16,
    numbers: Sequence[str] = (),
    words: Sequence[str] = ("source", "lang"),
    bits: int = 5,
) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` for every row, and the dimensions.

    ``size`` is the bytes of the text and one more (a null text has none), which
    is always a dimension besides ``numbers`` and ``words``.  The numbers of rows
    in the shards are at most one apart; ``slot`` counts from 0 in each.  Rows
    that are alike in ``doc_id``, size and checksum are interchangeable.
    """
    text = F.coalesce("text", F.lit(""))
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (utf8_size(text) + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            *[F.col(n) for n in (*numbers, *words)],
        ),
        "shard-rows",
    )
    dimensions = 1 + len(numbers) + len(words)
    placed = rows.withColumn("steps", F.array(*quantised(rows, ("size", *numbers), words, bits)))
    counted = placed.groupBy("steps").agg(F.count("*").alias("n"))
    along = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    # at most 2 ** (bits * dimensions) rows; written, so that the curve is computed once
    cells = written(
        counted.select(
            "steps",
            hilbert_index(F.col("steps"), bits, dimensions).alias("curve"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
            "n",
        ),
        "shard-cells",
    ).withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    total = rows.count()
    dealt = placed.join(cells, "steps").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("blocks")).cast("int")
    )
    in_cell = Window.partitionBy("curve").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        dealt.groupBy("curve", "block")
        .agg(F.count("*").alias("in_block"))
        .withColumn("blocks_before", F.coalesce(F.sum("in_block").over(in_cell), F.lit(0)))
    )
    in_block = Window.partitionBy("curve", "block").orderBy("doc_id", "text_crc32", "size")
    place = F.col("before") + F.col("blocks_before") + F.row_number().over(in_block) - 1
    # a run of the curve for each shard; the first place of run s is ceil(s * total / shards)
    return (
        dealt.join(blocks.select("curve", "block", "blocks_before"), ["curve", "block"])
        .withColumn("place", place)
        .withColumn("shard", F.expr(f"cast((place * {shards}) div {max(total, 1)} as int)"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            *numbers,
            *words,
            "curve",
            "shard",
            F.expr(f"place - (shard * {max(total, 1)}L + {shards - 1}) div {shards}").alias("slot"),
        )
    )


def shard_bounds(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, least and largest value of the columns in each shard: what a reader prunes by."""
    return assigned.groupBy("shard").agg(
        F.count("*").alias("rows"),
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))],
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """The rows of ``docs`` with their shard and slot, a folder a shard, each file in
    the order of the curve.  Rows that share a ``doc_id`` go where any of them goes."""
    keys = assigned.groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(F.struct("shard", "slot")).alias("_at")
    )
    (
        docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")))
        .select(*docs.columns, F.col("_at.shard").alias("shard"), F.col("_at.slot").alias("slot"))
        .repartition("shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
