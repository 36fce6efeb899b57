"""Streams whose state is a table."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlog.operators import search
from roadlog.operators.nested import schema_profile
from roadlog.streaming import commits, state

READING = "id STRING, timestamp LONG, kmh DOUBLE"
HOUR = 3_600_000
DAY = 24 * HOUR


@pytest.fixture
def readings(spark, tmp_path):
    def add(*data):
        spark.createDataFrame(data, READING).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    return add, lambda: spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_copies_go_however_late(spark, tmp_path, readings):
    add, stream = readings

    def run():
        state.start_dedup(stream(), f"{tmp_path}/t", f"{tmp_path}/ledger", f"{tmp_path}/check").awaitTermination()
        return sorted((r["id"], r["timestamp"], r["kmh"]) for r in rows(commits.read(spark, f"{tmp_path}/t", READING)))

    add(("a", 1, 1.0), ("a", 1, 0.5), ("b", 2, 3.0))
    add(("a", 90 * DAY, 7.0), ("a", 1, 9.0))
    assert run() == [("a", 1, 0.5), ("a", 90 * DAY, 7.0), ("b", 2, 3.0)]
    # months behind: a copy goes, a new row stays
    add(("b", 2, 4.0), ("b", 3, 5.0))
    state.compact_ledger(spark, f"{tmp_path}/ledger", trim=True)
    expected = [("a", 1, 0.5), ("a", 90 * DAY, 7.0), ("b", 2, 3.0), ("b", 3, 5.0)]
    assert run() == expected
    # the last batch runs again: its folder is replaced by an equal one
    last = max(int(p.name) for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "check" / "commits" / name).unlink()
    assert run() == expected
    assert commits.read(spark, f"{tmp_path}/ledger", state._LEDGER).count() == 4
    # only the days of a batch are looked at
    pruned = commits.read(spark, f"{tmp_path}/ledger", state._LEDGER, where=F.col("_day") == F.lit("1970-01-01").cast("date"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan


KEYS = [T.StructField("id", T.StringType())]
METRICS = [T.StructField("kmh", T.DoubleType())]


def test_days_are_corrected(spark, tmp_path, readings):
    add, stream = readings

    def run():
        state.start_daily(stream(), f"{tmp_path}/daily", f"{tmp_path}/check", ("id",), ("kmh",)).awaitTermination()
        got = rows(state.daily(spark, f"{tmp_path}/daily", KEYS, METRICS))
        return {(r["id"], r["month"], r["day"]): (r["avg_kmh"], r["min_kmh"], r["max_kmh"], r["rows"]) for r in got}

    add(("a", 0, 1.0), ("a", HOUR, 3.0), ("b", 0, None))
    add(("a", 40 * DAY, 8.0))
    first = {("a", 1, 1): (2.0, 1.0, 3.0, 2), ("b", 1, 1): (None, None, None, 1), ("a", 2, 10): (8.0, 8.0, 8.0, 1)}
    assert run() == first
    add(("a", 5, 11.0), ("b", 7, 2.0), (None, 7, 1.0))
    corrected = {**first, ("a", 1, 1): (5.0, 1.0, 11.0, 3), ("b", 1, 1): (2.0, 2.0, 2.0, 2), (None, 1, 1): (1.0, 1.0, 1.0, 1)}
    assert run() == corrected
    parts = commits.read(spark, f"{tmp_path}/daily", state._part_schema(KEYS, METRICS))
    assert parts.count() == 6
    state.compact_daily(spark, f"{tmp_path}/daily", KEYS, METRICS, trim=True)
    assert commits.read(spark, f"{tmp_path}/daily", state._part_schema(KEYS, METRICS)).count() == 4
    assert run() == corrected


def test_new_files_are_profiled(spark, tmp_path):
    def put(name, *docs):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(json.dumps(d) for d in docs) + "\n")

    def run():
        state.start_profile(spark, f"{tmp_path}/in", f"{tmp_path}/p", f"{tmp_path}/check").awaitTermination()
        return {(r["path"], r["type"]): r["n"] for r in rows(state.profile(spark, f"{tmp_path}/p"))}

    put("one", {"a": 1, "b": {"c": "x"}}, {"a": "y"})
    assert run() == {("a", "int"): 1, ("a", "str"): 1, ("b", "dict"): 1, ("b.c", "str"): 1}
    # what has been profiled may be gone
    (tmp_path / "in" / "one").rename(tmp_path / "elsewhere")
    put("two", {"a": 2})
    assert run() == {("a", "int"): 2, ("a", "str"): 1, ("b", "dict"): 1, ("b.c", "str"): 1}
    gone = commits.read(spark, f"{tmp_path}/p", state._PROFILE).filter("file LIKE '%/one'").select("file").distinct()
    assert [tuple(r.values()) for r in rows(state.profile(spark, f"{tmp_path}/p", gone))] == [("a", "int", 1)]


def test_list_of_commits(spark, tmp_path):
    root = f"{tmp_path}/t"
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    values = lambda **o: sorted(r["v"] for r in rows(commits.read(spark, root, "v long", **o)))
    assert values() == []
    commits.append(df(1, 2), root, 0)
    commits.append(df(3), root, 1)
    commits.append(df(4), root, 1)
    assert values() == [1, 2, 4] and values(before=1) == [1, 2]
    commits.compact(spark, root, "v long")
    commits.append(df(5), root, 2)
    assert values() == [1, 2, 4, 5] and values(before=1) == [1, 2] and values(before=2) == [1, 2, 4]
    commits.append(df().limit(0), root, 3)
    commits.compact(spark, root, "v long", combine=lambda d: d.agg(F.sum("v").alias("v")), trim=True)
    assert values() == [12]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_profile_by_index(spark):
    docs = spark.createDataFrame(
        [("a", '{"x":1}'), ("a", '{"x":"t","y":{"z":1}}'), ("b", '{"x":1}'), (None, '{"x":2}'), ("b", None)],
        "_index string, source string",
    )
    caps = rows(search.field_caps(search.fields_by_index(docs)), "field", "type")
    assert [(r["field"], r["type"], r["indices"]) for r in caps] == [
        ("x", "int", ["", "a", "b"]), ("x", "str", ["a"]), ("y", "dict", ["a"]), ("y.z", "int", ["a"])
    ]
    clash = docs.withColumn("path", F.col("_index"))
    assert {r["path"] for r in rows(schema_profile(clash, "source"))} == {"x", "y", "y.z"}
