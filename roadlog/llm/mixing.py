"""Mix sources to target weights under a token budget.

Sources are the leaves of a tree (by default domain, language, source).  A node
can give as many tokens as its leaves hold, times the epochs allowed.  The
budget goes down the tree: a node deals its tokens to its children by their
weights; a child that can give less than its share gives all it has, and what is
missing is dealt to its siblings again by weight.  As the bound of a child is
that of its whole subtree, a shortage is made up inside the subtree first, and
only what the subtree cannot give goes to the siblings above.  All amounts are
whole tokens, rounded down (less than one token is lost at a node).

A leaf gives its tokens in seeded epochs: whole passes over its documents, then
the longest prefix that fits of one more pass in an order drawn from the seed, the
number of the pass, ``doc_id`` and the text.  The prefix is found by blocks of that order
(sums of blocks first, running sums inside a block), so a leaf of any size is cut
by many tasks.  Rows alike in id and text are one unit of the order, counted before it is
made; where a prefix ends inside such a unit, some of its rows are in it and some not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlog.llm.common import WORD
from roadlog.operators.ordered import positions
from roadlog.workspace import written

# documents in a block of a leaf's order, about
BLOCK = 4096


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Level:
    """A level of the tree: its name, the node of a row, the weight (a positive
    whole number below a million) as a column of the node's name."""

    name: str
    node: Column
    weight: Column


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def deal(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Adds ``given`` to ``nodes``: the parent's ``budget`` dealt by ``weight``, at most ``most``.

    In the order of ``most / weight`` the nodes that give all they have come
    first, so running sums show how far they reach.
    """
    siblings = Window.partitionBy(*parent)
    order = siblings.orderBy(F.col("most") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    full = _exact("most") * _exact("rest") <= _exact("weight") * (_exact("budget") - _exact("dealt"))
    return (
        nodes.withColumns(
            {
                "dealt": F.coalesce(F.sum("most").over(before), F.lit(0)),
                "rest": F.sum("weight").over(onward),
                "rank": F.row_number().over(order),
            }
        )
        .withColumn("open", F.when(~full, F.col("rank")))
        .withColumn("first", F.min("open").over(siblings))
        .withColumn("full", F.col("first").isNull() | (F.col("rank") < F.col("first")))
        .withColumns(
            {
                "taken": F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(siblings), F.lit(0)),
                "sharing": F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings),
            }
        )
        .withColumn(
            "given",
            F.when(F.col("full"), F.col("most")).otherwise(
                F.least(
                    F.col("most"),
                    F.expr(
                        "(cast(weight as decimal(19,0)) * cast(budget - taken as decimal(19,0)))"
                        " div cast(sharing as decimal(19,0))"
                    ),
                )
            ),
        )
        .drop("dealt", "rest", "rank", "open", "first", "full", "taken", "sharing")
    )


def leaf_budgets(leaves: DataFrame, levels: Sequence[Level], budget: int, epochs: int) -> DataFrame:
    """``leaves`` (level columns, ``tokens, n``) with ``given`` tokens each."""
    names = [level.name for level in levels]
    current = None
    for depth, level in enumerate(levels):
        path = names[: depth + 1]
        nodes = (
            leaves.groupBy(*path)
            .agg((F.sum("tokens") * epochs).alias("most"))
            .withColumn("weight", level.weight.cast("long"))
        )
        if current is None:
            total = F.sum("most").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("budget", F.least(F.lit(budget).cast("long"), total))
        else:
            nodes = nodes.join(current, path[:-1])
        current = deal(nodes, path[:-1] or [F.lit(0)], level.name).select(
            *path, F.col("given").alias("budget")
        )
    return leaves.join(current.withColumnRenamed("budget", "given"), names)


def mix(
    docs: DataFrame,
    levels: Sequence[Level],
    share: tuple[int, int] = (1, 2),
    epochs: int = 3,
    seed: int = 7,
    tokens: Column | None = None,
) -> DataFrame:
    """``doc_id``, the levels, ``tokens`` and ``copies`` (0 and up) for every row.

    The budget is ``share`` (numerator, denominator) of all tokens; no document is
    used more than ``epochs`` times.  ``tokens`` defaults to the number of words.
    A null node counts as the node ``''``, a null text has no tokens.  Rows that
    share a ``doc_id``, and rows without one, are documents of their own; of rows alike in
    id and text some may be used once more than others.  ``text_key`` names the text.
    """
    names = [level.name for level in levels]
    text_key = F.md5(F.coalesce("text", F.lit("")).cast("binary")) if "text" in docs.columns else F.md5(F.lit(b""))
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            *[F.coalesce(level.node, F.lit("")).alias(level.name) for level in levels],
            (word_count() if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0))).alias("tokens"),
            text_key.alias("text_key"),
        ),
        "mix-rows",
    )
    # rows alike are one unit; a unit as a rule is one row
    units = written(
        rows.groupBy("doc_id", *names, "tokens", "text_key").agg(F.count("*").alias("n_rows")), "mix-units"
    )
    # one row a leaf
    leaves = written(
        units.groupBy(*names).agg(F.sum(F.col("tokens") * F.col("n_rows")).alias("tokens"), F.count("*").alias("n")),
        "mix-leaves",
    )
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = leaf_budgets(leaves, levels, total * share[0] // share[1], epochs).select(
        *names,
        F.expr("if(tokens = 0, 0, given div tokens)").alias("passes"),
        F.expr("if(tokens = 0, 0, given % tokens)").alias("prefix"),
        F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n") / BLOCK))).cast("int").alias("digits"),
    )
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    order = F.md5(F.concat_ws("/", F.lit(seed), "passes", doc_id, "text_key"))
    placed = written(
        units.join(budgets, names)
        .withColumn("held", F.col("tokens") * F.col("n_rows"))
        .withColumn("order", order)
        .withColumn("block", F.substring("order", F.lit(1), F.col("digits"))),
        "mix-placed",
    )
    blocks = (
        placed.groupBy(*names, "block")
        .agg(F.sum("held").alias("in_block"))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("in_block").over(
                    Window.partitionBy(*names).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("in_block")
    )
    # the tokens of a row tell units apart that share all else
    in_block = (
        Window.partitionBy(*names, "block")
        .orderBy("order", "doc_id", "tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.col("before") + F.coalesce(F.sum("held").over(in_block), F.lit(0))
    room = F.greatest(F.col("prefix") - earlier, F.lit(0))
    # units without tokens fit wherever the prefix has not ended
    fitting = F.when(F.col("tokens") == 0, F.when(earlier <= F.col("prefix"), F.col("n_rows")).otherwise(0)).otherwise(
        F.least(F.col("n_rows"), F.expr("_room div greatest(tokens, 1)"))
    )
    fits = (
        placed.join(blocks, [*names, "block"])
        .withColumn("_room", room)
        .withColumn("_more", F.when(F.col("prefix") > 0, fitting).otherwise(0))
        .select("doc_id", *names, "tokens", "text_key", "n_rows", F.col("passes").alias("_all"), "_more")
    )
    key = ["doc_id", *names, "tokens", "text_key"]
    return _dealt_to_rows(rows, fits, key).select("doc_id", *names, "tokens", "text_key", F.col("_copies").alias("copies"))


def _dealt_to_rows(rows: DataFrame, units: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` with ``_copies``: ``_all`` of their unit, and one more for ``_more`` of its ``n_rows``.

    Rows are counted out only in units that are neither whole nor left out, of which a
    leaf has one at most.
    """
    units = written(units, "mix-fits")
    whole = (F.col("_more") == 0) | (F.col("_more") >= F.col("n_rows"))

    def joined(part: DataFrame) -> DataFrame:
        named = part.select(*[F.col(c).alias(f"_u{i}") for i, c in enumerate(key)], "_all", "_more")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_u{i}")) for i, c in enumerate(key)])
        return rows.join(named, same)

    even = joined(units.filter(whole)).withColumn("_copies", F.col("_all") + F.least(F.col("_more"), F.lit(1)))
    names = [f"_u{i}" for i in range(len(key))]
    counted = positions(joined(units.filter(~whole)), names, "_place")
    # the first place of each unit; as many rows as leaves
    first = counted.groupBy(*names).agg(F.min("_place").alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_f{c}")) for c in names])
    odd = counted.join(first.select(*[F.col(c).alias(f"_f{c}") for c in names], "_first"), same).withColumn(
        "_copies", F.col("_all") + (F.col("_place") - F.col("_first") < F.col("_more")).cast("long")
    )
    return even.select(*rows.columns, "_copies").unionAll(odd.select(*rows.columns, "_copies"))


def mixed_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``mixed (doc_id, text_key, copies)`` says; of rows
    alike in id and text any come as often as it says of them together."""
    units = mixed.groupBy("doc_id", "text_key").agg(F.sum("copies").alias("_sum"), F.count("*").alias("n_rows")).select(
        F.col("doc_id").alias("_doc_id"),
        F.col("text_key").alias("_text_key"),
        "n_rows",
        F.expr("_sum div n_rows").alias("_all"),
        (F.col("_sum") % F.col("n_rows")).alias("_more"),
    )
    rows = docs.withColumns(
        {
            "_doc_id": F.col("doc_id").cast("long"),
            "_text_key": F.md5(F.coalesce("text", F.lit("")).cast("binary")),
        }
    )
    return (
        _dealt_to_rows(rows, units.filter("_all + _more > 0"), ["_doc_id", "_text_key"])
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*docs.columns)
    )
