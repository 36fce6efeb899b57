"""Running values along an order, for keys of any size.

A window over a whole key runs in one task, which a key that owns a third of
the table does not survive.  So rows first get their position in the table
(:func:`positions`, any order, also by several columns), without gaps.  The
positions are cut into blocks of ``2**block_bits``; windows run inside
``(key, block)``, so no task holds more than ``2**block_bits`` rows of a key, and
what the earlier blocks hand on is found from one summary row per block: a key
with all of ``n`` rows leaves ``n / 2**block_bits`` summaries to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlog.workspace import written

BLOCK_BITS = 16


def positions(df: DataFrame, order: Sequence[str | Column], name: str = "place") -> DataFrame:
    """Add ``name``: the place of the row in the table along ``order``, from 0, without gaps.

    Rows are dealt into ranges of the order by Spark's sampling, sorted, and written
    with the number of their range and their number in it, so both hold still; what
    is left is to add the sizes of the ranges before.  Rows alike in ``order`` get
    places next to each other.
    """
    # an id has the range in its bits from 33 on, and the number of the row in the others
    dealt = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "positions",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # a row a range
    starts = (
        dealt.groupBy(F.shiftright("_at", 33).alias("_range"))
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    number = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        dealt.withColumn("_range", F.shiftright("_at", 33))
        .join(F.broadcast(starts), "_range")
        .select(*df.columns, (F.col("_start") + number).alias(name))
    )


def _running(how: str, value: str, keys: Sequence[str], order: str) -> Column:
    """The value over the rows of the window strictly before the row."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (F.sum(value) if how == "sum" else F.last(value, ignorenulls=True)).over(window)


def _before(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, how: str, bits: int, levels: int
) -> DataFrame:
    """Add ``name``: the sum, or the last non-null, of ``value`` before the row."""
    if levels == 0:
        return df.withColumn(name, _running(how, value, keys, order))
    block, final, carried = f"_block{levels}", f"_final{levels}", f"_carried{levels}"
    rows = df.withColumn(block, F.shiftright(F.col(order), bits))
    if how == "sum":
        summary = F.sum(value)
    else:
        summary = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    blocks = _before(
        rows.groupBy(*keys, block).agg(summary.alias(final)), keys, block, final, carried, how, bits, levels - 1
    )
    handed_on = blocks.filter(F.col(carried).isNotNull()).select(*keys, block, carried)
    joined = rows.withColumn(name, _running(how, value, [*keys, block], order)).join(
        handed_on, [*keys, block], "left"
    )
    if how == "sum":
        both = F.when(
            F.col(name).isNotNull() | F.col(carried).isNotNull(),
            F.coalesce(name, F.lit(0)) + F.coalesce(carried, F.lit(0)),
        )
    else:
        both = F.coalesce(name, carried)
    return joined.withColumn(name, both).select(*df.columns, name)


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    name: str,
    block_bits: int = BLOCK_BITS,
    levels: int = 1,
) -> DataFrame:
    """Add ``name``: the last non-null ``value`` of the key strictly before the row.

    ``order`` is a BIGINT, unique within the key; the bound on a task's rows holds
    when it has few gaps, as :func:`positions` gives it.  Keys must not be null.
    """
    found = _before(df.withColumn("_value", value), keys, order, "_value", name, "last", block_bits, levels)
    return found.drop("_value")


def rank_in_order(
    df: DataFrame,
    order: str,
    name: str = "rank",
    keys: Sequence[str] = (),
    block_bits: int = BLOCK_BITS,
    levels: int = 1,
) -> DataFrame:
    """Add ``name``: position from 0 along the order, over the table or per key.

    Keys must not be null.
    """
    if not keys:
        return positions(df, [order], name)
    counted = _before(
        df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one", name, "sum", block_bits, levels
    )
    return counted.withColumn(name, F.coalesce(name, F.lit(0).cast("long"))).drop("_one")
