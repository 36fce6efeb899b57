"""Fingerprints of documents that can be subtracted: invertible Bloom lookup sketches.

A text is a set of paragraphs: its lines, longer ones cut after ``WORDS`` words.
Each paragraph has a 64-bit digest.  A sketch has three tables of cells; a digest falls into one cell of each table, and a cell holds how many
digests fell into it, their exclusive or, and the exclusive or of their check
values.  Two sketches subtract cell by cell, and what both texts have cancels.
Peeling reads the rest: a cell with one digest left shows it, the digest is taken
out of its other cells, and so on until nothing is left.  The recovered digests
say how much the versions differ.

The stored sketch of a text has room for its paragraphs: two of them have three
cells at least.  Of two stored sketches the larger is folded to the size of the
smaller (the cells of a table whose numbers end alike are added up), then they are
subtracted.  If peeling gets stuck, the sketches are too small for the difference,
which is sketched again, four times larger, from the digests.

All of it is higher-order functions over arrays in the row: no shuffle, work in
proportion to the paragraphs but for the way through groups of cells (a large
sketch does not look at every digest for every cell).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlog.llm.common import let, texts
from roadlog.workspace import written

WORDS = 32
# a table of a stored fingerprint has 2 ** BITS cells at least
BITS = 3
# a digest has so many bits for its cell in each table, so a table has no more cells; a
# difference that does not fit these is compared as sets
_HASH_BITS = 20


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by)


def digests(text: Column | str) -> Column:
    """The distinct digests of the paragraphs of a text, an array of longs."""
    # fixed form: up to WORDS words, the blanks after them, not past the end of the line
    paragraphs = F.regexp_extract_all(
        text, F.lit(rf"(?:[^\x20\x09-\x0D]++[\x20\x09\x0B\x0C]*+){{1,{WORDS}}}+"), F.lit(0)
    )
    return F.array_distinct(F.transform(paragraphs, lambda p: F.xxhash64(p)))


def table_bits(n: Column) -> Column:
    """Bits of a table for ``n`` digests: it has at least a cell for two of them."""
    halves = F.length(F.bin(F.greatest(n, F.lit(1)).cast("long") - 1)) - 1
    return F.least(F.greatest(halves, F.lit(BITS)), F.lit(_HASH_BITS))


def layout(bits: Column) -> Column:
    """The measures of three tables of ``2 ** bits`` cells, to be bound once by ``let``:
    cells in a table, in a group, groups in a table, and the shift from cell to group.
    A group has about the square root of a table."""
    width = F.floor((bits + 1) / 2).cast("int")
    return F.struct(
        _shift("shiftleft", F.lit(1), bits).alias("cells"),
        _shift("shiftleft", F.lit(1), width).alias("per_group"),
        _shift("shiftleft", F.lit(1), bits - width).alias("groups"),
        width.alias("width"),
        bits.cast("int").alias("bits"),
    )


def _cell(digest: Column, table: int, size: Column) -> Column:
    """Place of the digest's cell among those of all three tables."""
    own = F.shiftrightunsigned(digest, _HASH_BITS * table).bitwiseAND((1 << _HASH_BITS) - 1).cast("int")
    return own.bitwiseAND(size["cells"] - 1) + size["cells"] * table


def _struct(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.alias("n"), key.alias("key"), check.alias("check"))


def empty(size: Column) -> Column:
    """Three tables without entries, one after the other."""
    nothing = F.lit(0).cast("long")
    return F.array_repeat(_struct(F.lit(0), nothing, nothing), size["cells"] * 3)


def put(cells: Column, entries: Column, size: Column) -> Column:
    """The cells after ``entries (digest, by)`` have been added (``by`` 1) or taken out (-1).

    Cells are visited in groups; a group that no entry falls into stays as it is.
    """

    def hits(table: int) -> Column:
        return F.transform(
            entries,
            lambda e: F.struct(
                _cell(e["digest"], table, size).alias("cell"),
                e["digest"].alias("digest"),
                F.xxhash64(e["digest"]).alias("check"),
                e["by"].alias("by"),
            ),
        )

    def cell(c: Column, at: Column, own: Column) -> Column:
        return F.aggregate(
            F.filter(own, lambda h: h["cell"] == at),
            c,
            lambda s, h: _struct(
                s["n"] + h["by"], s["key"].bitwiseXOR(h["digest"]), s["check"].bitwiseXOR(h["check"])
            ),
        )

    def group(old: Column, g: Column, found: Column) -> Column:
        return let(
            found,
            lambda own: F.when(F.size(own) == 0, old).otherwise(
                F.transform(old, lambda c, i: cell(c, g * size["per_group"] + i, own))
            ),
        )

    def groups(all_cells: Column, tables: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), size["groups"] * 3 - 1),
            lambda g: group(
                F.slice(all_cells, g * size["per_group"] + 1, size["per_group"]),
                g,
                F.filter(
                    F.get(tables, F.floor(g / size["groups"]).cast("int")),
                    lambda h: _shift("shiftright", h["cell"], size["width"]) == g,
                ),
            ),
        )

    return let(
        F.struct(cells.alias("cells"), F.array(*map(hits, range(3))).alias("tables")),
        lambda x: F.flatten(groups(x["cells"], x["tables"])),
    )


def entries(found: Column, by: int) -> Column:
    return F.transform(found, lambda d: F.struct(d.alias("digest"), F.lit(by).alias("by")))


def sketch(found: Column, size: Column) -> Column:
    """Cells of an array of distinct digests; ``size`` is a bound :func:`layout`."""
    return put(empty(size), entries(found, 1), size)


def subtract(a: Column, b: Column) -> Column:
    """Cell by cell; of sketches of one size."""
    return F.zip_with(
        a,
        b,
        lambda x, y: _struct(
            x["n"] - y["n"], x["key"].bitwiseXOR(y["key"]), x["check"].bitwiseXOR(y["check"])
        ),
    )


def fold(cells: Column, size: Column, to: Column) -> Column:
    """The sketch in the smaller layout ``to``, as if it had been made in it."""

    def cell(at: Column) -> Column:
        table, own = F.floor(at / to["cells"]), at % to["cells"]
        return F.aggregate(
            F.sequence(F.lit(1), (size["cells"] / to["cells"]).cast("int") - 1),
            F.get(cells, (table * size["cells"] + own).cast("int")),
            lambda s, k: let(
                F.get(cells, (table * size["cells"] + k * to["cells"] + own).cast("int")),
                lambda c: _struct(s["n"] + c["n"], s["key"].bitwiseXOR(c["key"]), s["check"].bitwiseXOR(c["check"])),
            ),
        )

    return F.when(size["cells"] <= to["cells"], cells).otherwise(
        F.transform(F.sequence(F.lit(0), to["cells"] * 3 - 1), cell)
    )


def _is_empty(cells: Column) -> Column:
    return F.forall(cells, lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))


def peel(cells: Column, size: Column, rounds: int = 60) -> Column:
    """``(left, right, whole)``: the digests only the first or only the second text
    has, and whether nothing was left over."""

    def alone(cells: Column, n: int) -> Column:
        """Digests that have a cell for themselves, each once, to be taken out."""
        pure = F.filter(cells, lambda c: (c["n"] == n) & (c["check"] == F.xxhash64(c["key"])))
        return entries(F.array_distinct(F.transform(pure, lambda c: c["key"])), -n)

    def state(cells: Column, taken: Column, done: Column) -> Column:
        return F.struct(cells.alias("cells"), taken.alias("taken"), done.alias("done"))

    def step(s: Column) -> Column:
        return let(
            F.concat(alone(s["cells"], 1), alone(s["cells"], -1)),
            lambda out: F.when(F.size(out) == 0, state(s["cells"], s["taken"], F.lit(True))).otherwise(
                state(put(s["cells"], out, size), F.concat(s["taken"], out), F.lit(False))
            ),
        )

    def side(taken: Column, by: int) -> Column:
        return F.transform(F.filter(taken, lambda e: e["by"] == by), lambda e: e["digest"])

    nothing = F.array().cast("array<struct<digest:bigint,by:int>>")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        state(cells, nothing, F.lit(False)),
        lambda s, _: F.when(s["done"], s).otherwise(step(s)),
        lambda s: F.struct(
            side(s["taken"], -1).alias("left"),
            side(s["taken"], 1).alias("right"),
            _is_empty(s["cells"]).alias("whole"),
        ),
    )


def stored(found: Column) -> Column:
    """``(size, cells)``: the sketch of an array of distinct digests that is kept as its fingerprint."""
    return let(
        layout(table_bits(F.size(found))),
        lambda size: F.struct(size.alias("size"), sketch(found, size).alias("cells")),
    )


def difference(a: Column, b: Column, of_a: Column, of_b: Column) -> Column:
    """``(left, right)``: what only one of two arrays of distinct digests holds.

    ``of_a`` and ``of_b`` are their stored sketches, which are folded to one size,
    subtracted and peeled.  After a failure the difference is sketched four times
    larger: the digests of one text are put in, those of the other taken out.
    A size that the numbers of digests alone show to be too small is passed over.
    """
    nothing = F.array().cast("array<bigint>")
    failed = F.struct(nothing.alias("left"), nothing.alias("right"), F.lit(False).alias("whole"))

    def attempt(size: Column, cells: Column) -> Column:
        return F.when(size["cells"] * 3 < F.abs(F.size(a) - F.size(b)), failed).otherwise(peel(cells, size))

    def from_stored(size: Column) -> Column:
        folded = [fold(x["cells"], x["size"], size) for x in (of_a, of_b)]
        return attempt(size, subtract(*folded))

    def larger(bits: Column) -> Column:
        return let(
            layout(bits),
            lambda size: attempt(size, put(empty(size), F.concat(entries(a, 1), entries(b, -1)), size)),
        )

    smaller = F.when(of_a["size"]["bits"] <= of_b["size"]["bits"], of_a["size"]).otherwise(of_b["size"])
    return let(
        smaller,
        lambda size: F.aggregate(
            # from the least of the larger sizes to the last that a digest has bits for
            F.sequence(size["bits"] + 2, F.greatest(size["bits"] + 2, F.lit(_HASH_BITS)), F.lit(2)),
            from_stored(size),
            lambda s, bits: F.when(s["whole"] | (bits > _HASH_BITS), s).otherwise(larger(bits)),
            lambda s: F.when(s["whole"], F.struct(s["left"].alias("left"), s["right"].alias("right"))).otherwise(
                F.struct(F.array_except(a, b).alias("left"), F.array_except(b, a).alias("right"))
            ),
        ),
    )


def likeness(a: Column, b: Column, of_a: Column, of_b: Column) -> Column:
    """Share of paragraphs in common, by the difference of the sketches; two texts
    without paragraphs are alike."""
    both = F.size(a) + F.size(b)
    return let(
        difference(a, b, of_a, of_b),
        lambda d: F.when(both == 0, 1.0).otherwise(
            (both - F.size(d["left"]) - F.size(d["right"])) / (both + F.size(d["left"]) + F.size(d["right"]))
        ),
    )


def packed(cells: Column) -> Column:
    """A sketch as text: two bytes of number, eight of key, four of check a cell, in base 64."""

    def field(c: Column, digits: int) -> Column:
        return F.lpad(F.hex(c), digits, "0")

    return F.base64(
        F.unhex(
            F.array_join(
                F.transform(
                    cells,
                    lambda c: F.concat(
                        field(c["n"].bitwiseAND(0xFFFF).cast("long"), 4),
                        field(c["key"], 16),
                        field(c["check"].bitwiseAND(F.lit(0xFFFFFFFF)), 8),
                    ),
                ),
                "",
            )
        )
    )


def compared(versions: DataFrame) -> DataFrame:
    """``doc_id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next`` of
    :func:`versions`: the sketches of a text, its edited text and the next one are made
    once, and the likenesses come from them."""
    found = {name: F.col(name) for name in ("found", "edited_found", "next_found")}

    def row(own: Column, edited: Column, following: Column) -> Column:
        return F.struct(
            packed(own["cells"]).alias("fingerprint"),
            packed(edited["cells"]).alias("edited_fingerprint"),
            likeness(found["found"], found["edited_found"], own, edited).alias("near_edited"),
            likeness(found["found"], found["next_found"], own, following).alias("near_next"),
        )

    sketches = F.struct(*[stored(c).alias(name) for name, c in found.items()])
    near = let(sketches, lambda s: row(*[s[name] for name in found]))
    return versions.withColumn("_near", near).select("doc_id", "text", "edited", "_near.*")


# stands for a null doc_id inside: it counts as the least
_NO_ID = -(2**63)


def successors(ids: DataFrame) -> DataFrame:
    """``id, next_id`` of distinct ids (longs): the next in descending order, after
    the last the first.

    Ids are dealt into ranges by Spark's sampling and written with their range, so
    an id looks for its neighbour in its range, and only the ends of ranges look
    at the next one.
    """
    dealt = written(
        ids.repartitionByRange("id").withColumn("range", F.spark_partition_id()), "id-ranges"
    )
    tops = dealt.groupBy("range").agg(F.max("id").alias("top"))
    # a row a range
    down = Window.orderBy(F.col("range").desc())
    below = tops.select("range", F.lead("top").over(down).alias("below"), F.first("top").over(down).alias("first"))
    in_range = Window.partitionBy("range").orderBy(F.col("id").desc())
    return (
        dealt.withColumn("next_here", F.lead("id").over(in_range))
        .join(F.broadcast(below), "range")
        .select(*ids.columns, F.coalesce("next_here", "below", "first").alias("next_id"))
    )


def versions(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edited, found, edited_found, next_found``: each text, the text
    with its last third replaced by the start of the next document (descending
    ``doc_id``, after the last the first), and the digests of both and of the next.

    The last ``floor(n / 3)`` code points give way to as many of the next text, or
    all it has.  A null text is empty, a null ``doc_id`` comes last.  If several
    rows share a ``doc_id``, the next document is the one of them whose text is the
    largest; a table of one document follows itself.
    """
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "text")
    third = F.floor(F.length("text") / 3).cast("int")
    links = written(successors(rows.groupBy("id").agg(F.max(third).alias("take"))), "next-ids")
    # of the next text only as much as is needed, and its digests
    heads = (
        rows.join(links.select(F.col("next_id").alias("id"), F.col("id").alias("before"), "take"), "id")
        .select(
            F.col("before").alias("id"),
            F.struct(
                F.substring("text", F.lit(1), F.col("take")).alias("head"), digests("text").alias("found")
            ).alias("next"),
        )
        .groupBy("id")
        .agg(F.max("next").alias("next"))
    )
    return (
        rows.join(heads, "id")
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.length("text") - third),
                F.substring(F.col("next.head"), F.lit(1), third),
            ),
        )
        .select(
            F.nullif("id", F.lit(_NO_ID)).alias("doc_id"),
            "text",
            "edited",
            digests("text").alias("found"),
            digests("edited").alias("edited_found"),
            F.col("next.found").alias("next_found"),
        )
    )
