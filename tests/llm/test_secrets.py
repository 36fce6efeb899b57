import hashlib
import random
import re

import numpy as np
import pytest
from llm.helpers import AWKWARD, awkward, found, no_docs, table_of

from roadlog.llm import secrets
from roadlog.llm.queries import QUERIES


def plain(text):
    """The fixed formats by the expressions as they are stated."""
    out = []
    stated = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(stated, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def random_text(rnd):
    bits = ["token", "TOKEN", "Api_Key", "apikey", " ", "=", ":", '"', "'", "AKIA", "Z9", "abcdef0123456789", "é", "ſecret", "-", "/", "ab"]
    return "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))


def test_fixed_formats():
    rnd = random.Random(1)
    for _ in range(3000):
        text = random_text(rnd)
        assert secrets.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "run, name",
    [
        ("0123456789" * 3, "decimal"),
        ("deadbeef00" * 3, "hex"),
        ("DEADBEEF00" * 3, "HEX"),
        ("MFRGGZDFMZTWQ2LK", "base32"),
        ("zz99aa88", "lower36"),
        ("ZZ99AA88", "upper36"),
        ("aB3+/xQ", "base64"),
        ("aB3-_xQ", "base64url"),
        ("internationalization", "lower26"),
        ("INTERNATIONAL8", "upper36"),
        ("InterNational", "mixed52"),
        ("", None),
        ("aB3-+", None),
    ],
)
def test_encoding(run, name):
    assert secrets.encoding_of(run) == name


def habits_of(texts):
    """Habits by loops over the distinct short words."""
    width = len(secrets._ALPHABET)
    counts = np.zeros((width + 1, width))
    words = set()
    for text in texts:
        for run in re.findall(r"[A-Za-z0-9+/_-]+", text):
            for m in re.finditer(r"([A-Za-z0-9+]+)([/_-]?)", run):
                if len(m[1]) < 20:
                    words.add(m[0])
    for word in words:
        before = secrets._START
        for c in word:
            counts[before, secrets._AT[c]] += 1
            before = secrets._AT[c]
    return counts, secrets.habits(counts)


SMALL_WORDS = "the key file of a path name was sent to port 8080 on Monday by user7 with Version2 and README or TODO".split()


def ordinary(rnd):
    while True:
        w = [rnd.choice(SMALL_WORDS) for _ in range(7)]
        kind = rnd.randint(0, 3)
        run = ["/".join(w), "_".join(w).lower() + f"_{rnd.randint(0, 99)}", "".join(x.title() for x in w), f"2024-{rnd.randint(10, 12)}-{rnd.randint(10, 28)}-{w[0]}-{w[1]}"][kind]
        if len(run) >= 20:
            return run


def test_battery_holds_for_uniform_symbols_and_not_for_patterns():
    rnd = random.Random(2)
    for name, symbols in secrets.ENCODINGS.items():
        for n in (20, 40, 200):
            low = [min(secrets.battery("".join(rnd.choice(symbols) for _ in range(n)), name)) for _ in range(200)]
            assert sum(p < 1e-4 for p in low) <= 4, (name, n)
    for run in ("a1" * 60, "0" * 90, "1234567890" * 9, "abcdefghijklmnopqrstuvwxyz0123456789" * 2):
        assert min(secrets.battery(run, secrets.encoding_of(run))) < 1e-4, run


def test_neighbours_are_counted_over_distinct_words(spark):
    rnd = random.Random(3)
    texts = ["see path/to/some_file-name, again path/to", "Key aB3+x9 of " + "k" * 25 + "_v2", "é" + "word " * 50, None, ""]
    texts += [" ".join(rnd.choice(SMALL_WORDS) for _ in range(9)) for _ in range(20)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert (secrets.neighbours(docs) == habits_of([t or "" for t in texts])[0]).all()


def test_chances_of_ordinary_strings_are_no_larger_than_stated():
    """Of strings drawn from the counted habits, few look uniform."""
    rnd = random.Random(4)
    _, chances = habits_of([" ".join(SMALL_WORDS)])
    p = []
    for _ in range(3000):
        run, before = "", secrets._START
        for _ in range(24):
            at = rnd.choices(range(len(secrets._ALPHABET)), np.exp(chances[before]))[0]
            run += secrets._ALPHABET[at]
            before = secrets._START if secrets._ALPHABET[at] in "/-_" else at
        p.append(secrets.p_value(run, chances))
    for level in (0.1, 0.01):
        assert np.mean([x <= level for x in p]) <= level + 3 * (level / 3000) ** 0.5


def test_longer_runs_tell_more():
    rnd = random.Random(3)
    _, chances = habits_of([" ".join(SMALL_WORDS)])
    symbols = secrets.ENCODINGS["base64"]
    means = []
    for n in (20, 40, 80, 160):
        values = sorted(secrets.p_value("".join(rnd.choice(symbols) for _ in range(n)), chances) for _ in range(80))
        means.append(values[40])
    assert means == sorted(means, reverse=True)


def test_step_up_rule_against_sorting():
    rnd = random.Random(4)
    s = secrets.Settings()
    for _ in range(50):
        cells = [rnd.choice([0, 0, 1, 3, 20, 60, 200]) for _ in range(rnd.randint(1, 60))]
        p = sorted(10 ** (-c / 16) for c in cells)
        reach = max((k for k in range(len(p)) if p[k] <= s.rate * (k + 1) / len(p)), default=-1)
        cut = secrets.threshold_cell({c: cells.count(c) for c in cells}, s)
        assert sum(c >= cut for c in cells) == reach + 1


@pytest.mark.parametrize("n, share", [(20, 0.5), (32, 0.9), (40, 0.9)])
def test_scan_finds_short_keys_among_nine_times_as_many_other_runs(spark, n, share):
    rnd = random.Random(n)
    rows, keys = [], set()
    for i, name in enumerate(("base64", "hex", "HEX", "lower36", "base32") * 12):
        key = "".join(rnd.choice(secrets.ENCODINGS[name]) for _ in range(n))
        while not encoded(key, name):
            key = "".join(rnd.choice(secrets.ENCODINGS[name]) for _ in range(n))
        rows.append((i, f"the note {key} of it"))
        keys.add((i, 9, 9 + n))
    rows += [(100 + i, f"in {ordinary(rnd)} or not {' '.join(rnd.choice(SMALL_WORDS) for _ in range(8))}") for i in range(540)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(secrets.scan(docs))
    finds = {(r["doc_id"], s["start"], s["finish"]) for r in got for s in r["spans"]}
    # long lower-case hexadecimal keys are found by their fixed format
    assert len(finds & keys) >= share * len(keys)
    assert len(finds - keys) <= max(1, 0.02 * len(finds))
    assert sum(r["n_tested"] for r in got) >= 540


def encoded(key, name):
    """A key that no narrower alphabet holds and that its separators do not cut."""
    return secrets.encoding_of(key) == name and not secrets._PIECES[0].fullmatch(key) is None


def test_pieces_between_separators(spark):
    rnd = random.Random(6)
    _, chances = habits_of([" ".join(SMALL_WORDS)])
    key = "".join(rnd.choice(secrets.ENCODINGS["base32"]) for _ in range(32))
    run = f"path/of-the/{key}"
    start, finish, p = secrets.tests_of(run, chances)
    assert run[start:finish] == key and p < 1e-6
    assert secrets.tests_of("=" * 30, chances) is None
    assert secrets.tests_of("my_long_identifier_name_v2", chances)[2] > 0.5


def test_query(spark, small):
    got = {r["doc_id"]: r for r in found(QUERIES["op4_secrets"](spark, small))}
    for d in table_of(small, "documents"):
        base = plain(d["text"])
        named = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = got[d["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        assert set(filter(None, named.split(","))) <= set(r["spans"].split(","))


def test_awkward(spark, awkward, no_docs):
    rows = found(secrets.scan(awkward))
    fixed = [
        (r["doc_id"], [(s["start"], s["kind"], s["finish"]) for s in r["spans"] if s["kind"] < 3]) for r in rows
    ]
    assert sorted(fixed, key=repr) == sorted(((i, plain(t or "")) for i, t, *_ in AWKWARD), key=repr)
    assert found(secrets.scan(no_docs)) == []
