import hashlib
import itertools
import math
import random
import re
import sys
import zlib

import pytest
from llm.helpers import found, table_of

from roadlog.llm import repair
from roadlog.llm.queries import QUERIES

sys.setrecursionlimit(20_000)  # the brute force goes a level deeper for each row

BLANKS = " \t\n\x0b\f\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        stripped = text.strip(BLANKS)
        out.append(
            "blank" if not stripped else "duplicate" if (role, text) in seen
            else "truncated" if stripped[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def cheapest(roles, faults):
    """Try the edits of the rows behind first; strings of roles are checked by expression."""
    known = {}

    def rest(i, last, made):
        """Cheapest (cost, audit, what happens) from row i when ``last`` is what ended the turns so far."""
        key = i, last, made
        if key in known:
            return known[key]
        ways = [(math.inf, "", ())]  # nothing more is made up here
        if i == len(roles) and last in ("", "ua"):
            ways.append((0, "", ()))
        goes = {"": "su", "s": "u", "u": "a", "ua": "u"}[last]
        after = {"s": "s", "u": "u", "a": "ua"}
        if made < 4:
            for r in set(goes) & set("ua"):
                cost, audit, does = rest(i, after[r], made + 1)
                ways.append((cost + 5, "I" + audit, (("I", r), *does)))
        if i < len(roles):
            cost, audit, does = rest(i + 1, last, 0)
            ways.append((cost + 2, "D" + audit, (("D", ""), *does)))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if roles[i][:1] and roles[i][:1] in goes:
                    cost, audit, does = rest(i + 1, after[roles[i][:1]], 0)
                    ways.append((cost + extra, "K" + audit, (("K", ""), *does)))
                for r in set(goes) & set("ua"):
                    cost, audit, does = rest(i + 1, after[r], 0)
                    ways.append((cost + extra + 1, "R" + audit, (("R", r), *does)))
        known[key] = min(ways)
        return known[key]

    return rest(0, "", 0)


def brute(rows):
    """conv -> what the query returns, from damaged rows ``(conv, turn, role, text)``."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        faults = faults_of(own)
        cost, audit, does = cheapest([r[1] for r in own], faults)
        names, kept, it = {"u": "user", "a": "assistant"}, [], iter(own)
        for edit, r in does:
            row = None if edit == "I" else next(it)
            if edit != "D":
                kept.append(f"{names[r] if r else row[1]}:{'' if row is None else row[2]}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in kept))
        turns = {r[0] for r in own} - {None}
        initials = [r[1][:1] for r in own]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def results(spark, rows, bits=repair.PIECE_BITS):
    df = spark.createDataFrame([(f"={r[0]}", *r[1:]) for r in rows], "conv_key string, turn long, role string, text string")
    got = repair.repair(df, bits)
    hashed = {r["conv_key"]: r["sha256"] for r in found(repair.digests(got.rows))}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {
        r["conv_key"][1:]: (*(r[c] for c in names), hashed.get(r["conv_key"], EMPTY)) for r in found(got.report)
    }


def test_program_against_every_repair():
    """All edits of all short conversations, with up to two turns made up in a place."""
    made = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    for roles in itertools.product("suat", repeat=2):
        for faults in itertools.product(("", "truncated", "blank"), repeat=2):
            best = None
            for gaps in itertools.product(made, repeat=3):
                for edits in itertools.product(("D", "K", "Ru", "Ra"), repeat=2):
                    if any(f == "blank" and e != "D" for f, e in zip(faults, edits)):
                        continue
                    said, audit, cost = "", "", 0
                    for i in range(3):
                        said, audit, cost = said + "".join(gaps[i]), audit + "I" * len(gaps[i]), cost + 5 * len(gaps[i])
                        if i < 2:
                            e = edits[i]
                            said += {"D": "", "K": roles[i]}.get(e, e[-1])
                            audit += e[0]
                            cost += {"D": 2, "K": 0}.get(e, 1) + (5 if faults[i] == "truncated" and e != "D" else 0)
                    if re.fullmatch("(s?(ua)+)?", said):
                        best = min(best or (cost, audit), (cost, audit))
            assert cheapest(roles, faults)[:2] == best, (roles, faults)


@pytest.mark.parametrize("bits", [14, 2, 0])
def test_against_brute_force(spark, bits):
    rnd = random.Random(bits)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "unknown", "", "User", " "]
    texts = ["Fine.", "Fine!", "no end", "", " \t", "a. b", "same?", "é", "one.", "two.", "three.", "four. \n"]
    rows = []
    for conv in range(60):
        for t in range(rnd.randint(1, 14)):
            turn = rnd.choice([t, t, t, t + 3, None, t // 2])
            rows.append((conv, turn, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"{conv} {t}."))
    rnd.shuffle(rows)
    expected = {str(c): x for c, x in brute(rows).items()}
    assert results(spark, rows, bits) == expected


def test_giant_conversation_in_pieces(spark):
    rnd = random.Random(8)
    rows = [("big", t, rnd.choice(["user", "assistant"]), rnd.choice([f"t {t}.", f"t {t}"])) for t in range(300)]
    rows += [("same", None, "user", "again.")] * 200 + [("small", 0, "user", "a."), ("small", 1, "assistant", "b.")]
    assert results(spark, rows, 4) == brute(rows)


def test_order_is_dealt_to_several_tasks(spark):
    rows = spark.range(20_000).selectExpr("'=a' AS conv_key", "id AS turn", "'user' AS role", "concat('t', id, '.') AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = repair.in_order(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.selectExpr("place >> 33 AS part").distinct().count() > 1
    out_of_order = placed.selectExpr("turn", "lag(turn) OVER (ORDER BY place) AS before").filter("before >= turn")
    assert out_of_order.count() == 0


def query_rows(spark, folder):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[c] for c in names) for r in QUERIES["op11_conversation_repair"](spark, folder).collect()}


def with_lost(rows):
    expected = brute(damage(rows))
    return {c: expected.get(c, (0, 0, 0, 0, 0, 0, "", EMPTY)) for c in {r[0] for r in rows}}


def test_query_against_brute_force(spark, small):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table_of(small, "conversations")]
    got = query_rows(spark, small)
    assert got == with_lost(rows)
    assert len({edit for r in got.values() for edit in r[6]}) >= 3


def test_nulls_repeats_long_texts_and_clashing_columns(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, 0, 1, 2**40]), rnd.choice([None, "user", "assistant"]),
             rnd.choice([None, "", "a.", "b", "x" * 100_000 + "."])) for _ in range(60)]
    rows += rows[:5] + [(7, i, "system", "Only system.") for i in range(3)]
    df = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows],
        "conv_id long, turn long, role string, text string, conv_key string, place int, piece int",
    )
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert query_rows(spark, str(tmp_path)) == with_lost(rows)


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    empty.write.parquet(f"{tmp_path}/conversations.parquet")
    assert query_rows(spark, str(tmp_path)) == {}
