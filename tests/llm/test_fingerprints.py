import base64
import hashlib
import random
import re
import struct

import pytest
import xxhash
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of
from pyspark.sql import functions as F

from roadlog.llm import fingerprints as fp
from roadlog.llm.queries import QUERIES


def paragraphs(text):
    return set(re.findall(r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B\x0C]*){1,%d}" % fp.WORDS, text))


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, after):
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def unpacked(print_):
    """Cells ``[n, key, check]`` of a returned fingerprint, three tables one after the other."""
    return [list(c) for c in struct.iter_unpack(">hQI", base64.b64decode(print_))]


def folded(cells, size):
    old, out = len(cells) // 3, [[0, 0, 0] for _ in range(3 * size)]
    for at, (n, key, check) in enumerate(cells):
        c = out[at // old * size + at % old % size]
        c[0], c[1], c[2] = c[0] + n, c[1] ^ key, c[2] ^ check
    return out


def peeled(cells):
    """The digests on either side, or None if some are left over."""
    size, sides = len(cells) // 3, {1: set(), -1: set()}
    found = True
    while found:
        found = False
        for c in cells:
            n, key, check = c
            own = xxhash.xxh64_intdigest(key.to_bytes(8, "little"), seed=42) & 0xFFFFFFFF
            if n in sides and check == own:
                sides[n].add(key)
                for t in range(3):
                    other = cells[t * size + (key >> 20 * t & 0xFFFFF) % size]
                    other[0], other[1], other[2] = other[0] - n, other[1] ^ key, other[2] ^ own
                found = True
    return None if any(any(c) for c in cells) else (sides[1], sides[-1])


def alike_by_prints(a, b):
    """Likeness by two returned fingerprints alone; None where their room does not suffice."""
    a, b = unpacked(a), unpacked(b)
    size = min(len(a), len(b)) // 3
    both = sum(c[0] for c in a[: len(a) // 3]) + sum(c[0] for c in b[: len(b) // 3])
    sides = peeled([[x[0] - y[0], x[1] ^ y[1], x[2] ^ y[2]] for x, y in zip(folded(a, size), folded(b, size))])
    if sides is None:
        # each by itself
        one, other = peeled(a), peeled(b)
        if one is None or other is None:
            return None
        sides = one[0] - other[0], other[0] - one[0]
    apart = len(sides[0]) + len(sides[1])
    return (both - apart) / (both + apart) if both else 1.0


def with_sketches(df):
    return df.select("*", fp.stored(F.col("a")).alias("of_a"), fp.stored(F.col("b")).alias("of_b"))


def difference():
    return fp.difference(*map(F.col, ("a", "b", "of_a", "of_b")))


def test_query(spark, small):
    got = {r["doc_id"]: r for r in found(QUERIES["op10_fingerprints"](spark, small))}
    docs = sorted(((d["doc_id"], d["text"]) for d in table_of(small, "documents")), reverse=True)
    assert len(got) == len(docs)
    prints = {}
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        r, e = got[i], edited(text, after)
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(text, e)) and r["near_next"] == pytest.approx(alike(text, after))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        room, n = len(base64.b64decode(r["fingerprint"])) // (3 * 14), len(paragraphs(text))
        assert room == max(2**fp.BITS, 2 ** (max(n - 1, 1).bit_length() - 1))
    assert len(set(prints.values())) == len(prints)
    # the likenesses are those of the returned columns
    known = 0
    for k, (i, _) in enumerate(docs):
        r, after = got[i], got[docs[(k + 1) % len(docs)][0]]
        pairs = (r["edited_fingerprint"], r["near_edited"]), (after["fingerprint"], r["near_next"])
        for other, near in pairs:
            by_prints = alike_by_prints(r["fingerprint"], other)
            known += by_prints is not None
            assert by_prints is None or by_prints == pytest.approx(near)
    assert known >= 0.9 * 2 * len(docs)


def test_folded_is_as_made_smaller(spark):
    rnd = random.Random(6)
    rows = [([rnd.getrandbits(64) - 2**63 for _ in range(n)],) for n in (0, 1, 7, 90)]
    df = spark.createDataFrame(rows, "a array<long>").select("a", *[fp.layout(F.lit(b)).alias(f"s{b}") for b in (3, 4, 7)])
    for big in (3, 4, 7):
        sketches = df.select(
            fp.fold(fp.sketch(F.col("a"), F.col(f"s{big}")), F.col(f"s{big}"), F.col("s3")).alias("folded"),
            fp.sketch(F.col("a"), F.col("s3")).alias("made"),
        )
        assert all(r["folded"] == r["made"] for r in found(sketches))


def test_room_grows_with_the_paragraphs(spark):
    counts = (0, 1, 16, 17, 32, 33, 64, 65, 5000, 2**22)
    df = spark.createDataFrame([(n,) for n in counts], "n int").select("n", fp.table_bits(F.col("n")).alias("bits"))
    assert {r["n"]: r["bits"] for r in found(df)} == dict(zip(counts, (3, 3, 3, 4, 4, 5, 5, 6, 12, 20)))


def test_differences_of_any_size(spark):
    rnd = random.Random(3)
    pairs = []
    for n in (0, 1, 2, 5, 20, 21, 60, 200, 900):
        for common in (0, 3, 400):
            pool = [rnd.getrandbits(64) - 2**63 for _ in range(n + common)]
            cut = rnd.randint(0, n)
            pairs.append((sorted(pool[:cut] + pool[n:]), sorted(pool[cut:n] + pool[n:])))
    pairs.append((list(range(50)), list(range(25, 75))))
    pairs += [(a, b[: len(b) // 9]) for a, b in pairs[-4:]]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    rows = found(with_sketches(df).select("a", "b", difference().alias("d")))
    assert len(rows) == len(pairs)
    for r in rows:
        a, b = set(r["a"]), set(r["b"])
        assert set(r["d"]["left"]) == a - b and len(r["d"]["left"]) == len(a - b)
        assert set(r["d"]["right"]) == b - a and len(r["d"]["right"]) == len(b - a)


def test_too_small_a_sketch_says_so(spark):
    rnd = random.Random(4)
    rows = [(rnd.sample(range(2**62), 60), rnd.sample(range(2**62), 3)) for _ in range(20)]
    df = spark.createDataFrame(rows, "many array<long>, few array<long>")
    df = df.withColumn("size", fp.layout(F.lit(3)))
    size = F.col("size")
    peeled = df.select(
        fp.peel(fp.sketch(F.col("many"), size), size).alias("stuck"), fp.peel(fp.sketch(F.col("few"), size), size).alias("read"), "few"
    )
    rows = found(peeled)
    assert not any(r["stuck"]["whole"] for r in rows)
    # three digests in 24 cells nearly always come out, and never wrongly
    assert sum(r["read"]["whole"] for r in rows) >= 18
    assert all(set(r["read"]["left"]) == set(r["few"]) for r in rows if r["read"]["whole"])


def test_sketches_of_one_size_subtract(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5])], "a array<long>, b array<long>")
    df = df.withColumn("size", fp.layout(F.lit(5)))
    size = F.col("size")
    cells = fp.subtract(fp.sketch(F.col("a"), size), fp.sketch(F.col("b"), size))
    (r,) = found(df.select(fp.peel(cells, size).alias("p")))
    assert (set(r["p"]["left"]), set(r["p"]["right"]), r["p"]["whole"]) == ({1, 2}, {5}, True)


def test_successors(spark):
    ids = [5, -(2**63), 7, 100, 2**62, -3]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    down = sorted(ids, reverse=True)
    assert {r["id"]: r["next_id"] for r in found(fp.successors(df))} == dict(zip(down, down[1:] + down[:1]))


def test_awkward(spark, awkward, no_docs):
    rows = found(fp.versions(awkward))
    texts = {}
    for i, t, *_ in AWKWARD:
        texts.setdefault(i, []).append(t or "")
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    after = {i: max(texts[n], key=lambda t: t.encode()) for i, n in zip(order, order[1:] + order[:1])}
    expected = sorted(((i, t or "", edited(t or "", after[i])) for i, t, *_ in AWKWARD), key=repr)
    got = sorted(((r["doc_id"], r["text"], r["edited"]) for r in rows), key=repr)
    assert [(i, len(t), len(e)) for i, t, e in got] == [(i, len(t), len(e)) for i, t, e in expected]
    assert got == expected
    near = found(fp.compared(fp.versions(awkward)))
    assert len(near) == len(AWKWARD)
    assert all(r["near_edited"] == pytest.approx(alike(r["text"], r["edited"])) for r in near)
    assert found(fp.compared(fp.versions(no_docs))) == []
    alone = spark.createDataFrame([(1, "only one document")], "doc_id long, text string")
    (r,) = found(fp.versions(alone))
    assert r["edited"] == edited(r["text"], r["text"])
