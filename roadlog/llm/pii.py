"""Personal data: fixed formats, and identifiers known by the company they keep.

The fixed formats (mail addresses, IP addresses, card and phone numbers) are the
seeds.  Every word-like token with a digit or an at sign is an occurrence of an
instance (the token without punctuation around it) in patterns that back off: the two
words before it, the one before it, the one behind it (lower case).  Patterns and instances form a graph whose edges are the
distinct pairs.  Scores go to and fro: a pattern scores the mean of its
instances, damped for patterns seen with few; an instance that is no seed scores
as if its patterns spoke independently.  After some rounds, patterns that score
high and were seen with enough different seeds are trusted, and whatever else
stands in them is reported as ``context``.

Everything is column expressions and joins of narrow tables.  A regular
expression gives strings and not places, so matches are paired with the pieces of
text between them, whose lengths add up to the places: within chunks of a few
matches, and over the sums of the chunks, so the work grows with the matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlog.llm.common import let
from roadlog.workspace import written

# fixed values: kinds in the order of the report
KINDS = ("email", "ip", "card", "phone", "context")

# The expressions say the same as the plain ones, in a form whose work is linear and
# whose loops need no stack: possessive where nothing follows that could need giving
# back, and tried only where a run of its first class starts or a match has ended.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text without this has no match
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

_BLANK = r"\x20\x09-\x0D"
_TOKEN = rf"(?<![^{_BLANK}])[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
_CORE = r"[0-9A-Za-z+](?:.*[0-9A-Za-z])?"
_EDGE = r"^[^0-9A-Za-z+]*+"
# leading zeros are given back to a part that is zero; a part can be read in one way only
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# code points around a token in which its words are looked for
_AROUND = 64


@dataclass(frozen=True)
class Settings:
    """``trust``: score from which a pattern is believed; ``seeds``: different seeds it
    must have been seen with; ``shortest``: characters of a discovered identifier."""

    rounds: int = 3
    trust: float = 0.8
    seeds: int = 3
    shortest: int = 5


_NO_MATCHES = "array<struct<start:int,finish:int,value:string,gap:string,after:string>>"
# matches whose places are added up one after the other
_CHUNK = 64


def _chunks(n: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((n - 1) / _CHUNK).cast("int"))


def _chunk(items: Column, number: Column) -> Column:
    return F.slice(items, number * _CHUNK + 1, F.lit(_CHUNK))


def _sums_before(values: Column) -> Column:
    """The sum of the values before each, of a short array."""
    return F.aggregate(
        values,
        F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out")),
        lambda a, v: F.struct((a["sum"] + v).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out")),
        lambda a: a["out"],
    )


def matches(text: Column | str, pattern: str) -> Column:
    """``(start, finish, value, gap, after)`` of all matches of an expression without groups;
    ``gap`` is the text between a match and the one before, ``after`` that up to the next.
    Places in code points."""
    text = F.col(text) if isinstance(text, str) else text

    def sized(found: Column) -> Column:
        return F.transform(
            F.arrays_zip(found.alias("value"), F.split(text, pattern, -1).alias("gap")),
            lambda p: F.struct(p["value"].alias("value"), p["gap"].alias("gap"), F.length(p["gap"]).alias("space"),
                               F.coalesce(F.length(p["value"]), F.lit(0)).alias("size")),
        )

    def placed_chunk(pieces: Column, offsets: Column, k: Column) -> Column:
        return F.aggregate(
            # with the piece behind it
            F.arrays_zip(_chunk(pieces, k).alias("p"), F.slice(pieces, k * _CHUNK + 2, F.lit(_CHUNK)).alias("next")),
            F.struct(F.get(offsets, k).alias("at"), F.array().cast(_NO_MATCHES).alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["p"]["space"] + x["p"]["size"]).alias("at"),
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + x["p"]["space"]).alias("start"),
                            (a["at"] + x["p"]["space"] + x["p"]["size"]).alias("finish"),
                            x["p"]["value"].alias("value"),
                            x["p"]["gap"].alias("gap"),
                            x["next"]["gap"].alias("after"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda a: a["out"],
        )

    def placed(pieces: Column) -> Column:
        # the last piece is the text behind the last match
        sums = F.transform(
            _chunks(F.size(pieces) - 1),
            lambda k: F.aggregate(_chunk(pieces, k), F.lit(0), lambda a, p: a + p["space"] + p["size"]),
        )
        return let(
            let(sums, _offsets),
            lambda offsets: F.filter(
                F.flatten(F.transform(_chunks(F.size(pieces) - 1), lambda k: placed_chunk(pieces, offsets, k))),
                lambda m: m["value"].isNotNull(),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, F.array().cast(_NO_MATCHES)).otherwise(let(sized(found), placed)),
    )


def _offsets(sums: Column) -> Column:
    """The sum of the sums before each chunk, again by chunks."""

    def within(k: Column, before: Column) -> Column:
        return F.transform(_sums_before(_chunk(sums, k)), lambda x: x + F.get(before, k))

    totals = F.transform(_chunks(F.size(sums)), lambda k: F.aggregate(_chunk(sums, k), F.lit(0), lambda a, v: a + v))
    return let(
        _sums_before(totals),
        lambda before: F.flatten(F.transform(_chunks(F.size(sums)), lambda k: within(k, before))),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """The check sum of card numbers, of a text of digits."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return let(
            _digits(value), lambda d: F.when(F.length(d).between(14, 19), passes_luhn(d)).otherwise(False)
        )
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _span(start: Column, kind: str, finish: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), finish.alias("finish"))


def base_spans(text: str = "text") -> Column:
    """``(start, kind, finish)`` of the fixed formats, sorted; matches that fail the
    check of their kind are dropped and not tried again."""
    nothing = F.array().cast("array<struct<start:int,kind:int,finish:int>>")

    def of(kind: str) -> Column:
        valid = F.filter(matches(text, _PATTERNS[kind]), lambda m: _holds(kind, m["value"]))
        spans = F.transform(valid, lambda m: _span(m["start"], kind, m["finish"]))
        if kind not in _NEEDS:
            return spans
        return F.when(F.contains(F.col(text), F.lit(_NEEDS[kind])), spans).otherwise(nothing)

    return F.array_sort(F.concat(*map(of, _PATTERNS)))


def occurrences(text: str = "text") -> Column:
    """``(start, finish, instance, patterns)`` of the tokens with a digit or an at sign
    that have words around them: ``2:`` the two before, ``1:`` the one before, ``0:`` the one behind."""

    def words(gap: Column) -> Column:
        return F.filter(F.split(gap, rf"[{_BLANK}]+"), lambda w: w != "")

    def patterns(m: Column) -> Column:
        before = words(F.substring(m["gap"], -_AROUND, _AROUND))
        behind = words(F.substring(F.coalesce(m["after"], F.lit("")), 1, _AROUND))
        both = F.when(F.size(before) >= 2, F.concat_ws(" ", F.lit("2:"), F.try_element_at(before, F.lit(-2)), F.try_element_at(before, F.lit(-1))))
        one = F.when(F.size(before) >= 1, F.concat_ws(" ", F.lit("1:"), F.try_element_at(before, F.lit(-1))))
        next_one = F.when(F.size(behind) >= 1, F.concat_ws(" ", F.lit("0:"), F.get(behind, F.lit(0))))
        return F.transform(F.array_compact(F.array(both, one, next_one)), F.lower)

    def occurrence(m: Column) -> Column:
        start = m["start"] + F.length(F.regexp_extract(m["value"], _EDGE, 0))
        instance = F.regexp_extract(m["value"], _CORE, 0)
        return F.struct(
            start.alias("start"),
            (start + F.length(instance)).alias("finish"),
            instance.alias("instance"),
            patterns(m).alias("patterns"),
        )

    return F.filter(
        F.transform(matches(text, _TOKEN), occurrence), lambda o: (F.size(o["patterns"]) > 0) & (o["instance"] != "")
    )


def trusted_patterns(edges: DataFrame, s: Settings) -> DataFrame:
    """``pattern`` of those that score at least ``trust``.

    ``edges (pattern, instance, seed)`` are distinct pairs.  Every round is two
    aggregates over the edges and a join each way; a pattern or instance with very
    many edges is summed before it is shuffled.
    """
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for _ in range(s.rounds):
        patterns = scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("belief"),
            F.sum(F.col("seed").cast("int")).alias("seeds"),
        )
        spoken = (
            edges.join(patterns, "pattern")
            .groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("belief"))))).alias("heard"))
        )
        scored = written(
            edges.join(spoken, "instance").select(
                "pattern", "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.col("heard")).alias("score")
            ),
            "pii-scores",
        )
    return (
        scored.groupBy("pattern")
        .agg((F.sum("score") / (F.count("*") + 1)).alias("belief"), F.sum(F.col("seed").cast("int")).alias("seeds"))
        .filter((F.col("belief") >= s.trust) & (F.col("seeds") >= s.seeds))
        .select("pattern")
    )


def _with_seeds(rows: DataFrame) -> DataFrame:
    """``row, start, finish, instance, patterns, seed`` of the tokens; a seed has characters
    in common with a span of the fixed formats.

    Spans of a text do not start after they end, so the ends of those that have started
    and the starts of those that have not tell it.
    """
    tokens = rows.select("row", F.inline("tokens"))
    spans = rows.select("row", F.explode("base").alias("b")).select("row", "b.start", "b.finish")
    both = tokens.withColumn("fixed", F.lit(False)).unionByName(
        spans.withColumn("fixed", F.lit(True)), allowMissingColumns=True
    )
    so_far = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    to_come = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ended = F.max(F.when(F.col("fixed"), F.col("finish"))).over(so_far)
    starts = F.min(F.when(F.col("fixed"), F.col("start"))).over(to_come)
    seed = F.coalesce(ended > F.col("start"), F.lit(False)) | F.coalesce(starts < F.col("finish"), F.lit(False))
    return both.withColumn("seed", seed).filter(~F.col("fixed")).drop("fixed")


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs (doc_id, text)``; ``spans`` are
    ``(start, kind, finish)`` in code points, sorted, ``kind`` an index into KINDS.

    A null or empty text has no spans; rows that repeat are scanned each.  Spans of
    the fixed formats are all there; ``context`` spans do not overlap them.
    """
    s = settings
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
        ).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            base_spans().alias("base"),
            occurrences().alias("tokens"),
        ),
        "pii-rows",
    )
    seen = _with_seeds(rows).withColumn("pattern", F.explode("patterns"))
    edges = written(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    finds = (
        seen.filter(~F.col("seed") & (F.length("instance") >= s.shortest))
        .join(trusted_patterns(edges, s), "pattern", "left_semi")
        .groupBy("row")
        # a token that stands in several trusted patterns is one find
        .agg(F.collect_set(_span(F.col("start"), "context", F.col("finish"))).alias("more"))
    )
    nothing = F.array().cast("array<struct<start:int,kind:int,finish:int>>")
    return rows.join(finds, "row", "left").select(
        "doc_id", F.array_sort(F.concat("base", F.coalesce("more", nothing))).alias("spans")
    )
