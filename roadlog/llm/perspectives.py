"""Dialogues as training texts, once from the side of every participant.

For each speaker of a conversation the whole dialogue is rendered with that
speaker as the assistant and the others as users under their names; the mask
names the stretches (in code points of the rendered text) that are learnt: what
the assistant says, with its end mark.  Roles that take no part (the system's
instructions) are rendered as they are in every perspective and never learnt.

A long conversation is rendered in parts of at most ``PART`` turns, cut by the
number of the turn, so no task holds more of it than a part; the parts in the
order of ``page, piece`` are the dialogue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 256

# fixed values: marks of the rendered text; a mark inside a turn is broken up
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
BROKEN = "< |"
# in a name also the end of a mark is broken up, and line ends become blanks
BROKEN_CLOSE, LINE_ENDS = "| >", r"[\n\r]"
UNNAMED = "unknown"


def _harmless(c: Column) -> Column:
    return F.replace(c, F.lit(OPEN), F.lit(BROKEN))


def _name(c: Column) -> Column:
    """A role that cannot close the header it stands in."""
    return F.regexp_replace(F.replace(_harmless(c), F.lit(CLOSE), F.lit(BROKEN_CLOSE)), LINE_ENDS, " ")


def header(role: Column, speaker: Column, bystanders: Sequence[str]) -> Column:
    name = (
        F.when(role == speaker, F.lit("assistant"))
        .when(role.isin(*bystanders), role)
        .otherwise(F.concat(F.lit("user name="), role))
    )
    return F.concat(F.lit(OPEN), name, F.lit(CLOSE + "\n"))


def render(turns: DataFrame, bystanders: Sequence[str] = ("system",)) -> DataFrame:
    """``conv_id, speaker, page, piece, n_turns, text, mask`` of ``turns (conv_id, turn, role, text)``.

    ``mask`` is an array of ``(start, finish)``, finish exclusive.  Turns are in
    the order of ``turn`` (null last), then role, then text; repeated turns are
    rendered repeatedly.  A null text is empty, a null role is ``unknown``, marks and
    line ends in a role are broken up (roles alike after that are one speaker), a null
    ``conv_id`` is a conversation like any other.  A conversation of bystanders
    alone has no perspective.
    """
    said = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _name(F.coalesce("role", F.lit(UNNAMED))).alias("role"),
        _harmless(F.coalesce("text", F.lit(""))).alias("text"),
    ).withColumn("page", F.floor(F.col("turn") / PART))
    in_page = Window.partitionBy("conv_id", "page").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    parts = (
        said.withColumn("place", F.row_number().over(in_page))
        .withColumn("piece", F.floor((F.col("place") - 1) / PART).cast("int"))
        .groupBy("conv_id", "page", "piece")
        # at most PART turns
        .agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    )
    speakers = (
        said.filter(~F.col("role").isin(*bystanders))
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker"))
        .distinct()
    )
    ended = F.lit(END + "\n")
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            header(t["role"], F.col("speaker"), bystanders).alias("head"),
            F.concat(t["text"], ended).alias("body"),
            (t["role"] == F.col("speaker")).alias("own"),
        ),
    )
    # where each body starts, counted on from the one before
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,finish:int>>").alias("mask")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(
                p["own"],
                F.concat(
                    a["mask"],
                    F.array(
                        F.struct(
                            (a["at"] + F.length(p["head"])).alias("start"),
                            (a["at"] + F.length(p["head"]) + F.length(p["body"]) - 1).alias("finish"),
                        )
                    ),
                ),
            )
            .otherwise(a["mask"])
            .alias("mask"),
        ),
        lambda a: a["mask"],
    )
    return (
        parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .withColumn("pieces", pieces)
        .select(
            "conv_id",
            "speaker",
            "page",
            "piece",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
            spans.alias("mask"),
        )
    )
