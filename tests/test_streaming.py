import json

import pytest
from conftest import rows

from pyspark.sql import types as T

from roadlog.operators import store
from roadlog.operators.rollups import group_count
from roadlog.sinks.tables import append_partitioned
from roadlog.sources.messages import read_messages
from roadlog.streaming import documents, ingest, rollups

VALUE = T.StructType([T.StructField("id", T.StringType()), T.StructField("kmh", T.DoubleType())])
READING = "id STRING, timestamp LONG, kmh DOUBLE"
HOUR = 3_600_000
DAY = 24 * HOUR


def message(ts, **value):
    return json.dumps({"timestamp": ts, "value": value})


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_incremental_ingest_equals_batch(spark, tmp_path):
    raw = tmp_path / "raw"

    def run():
        read = ingest.stream_messages(spark, str(raw), VALUE, max_files=1)
        ingest.start_table(read.rows, f"{tmp_path}/table", f"{tmp_path}/c1").awaitTermination()
        ingest.start_table(read.rejects, f"{tmp_path}/bad", f"{tmp_path}/c2", by=()).awaitTermination()

    put(raw, "2021-08-06--07/a", message(1628233200123, id="a", kmh=1.0) + "\n{oops")
    put(raw, "2021-08-06--08/b", message(1628236800000, id="b", kmh=2.0))
    run()
    run()  # nothing new: nothing is read twice
    put(raw, "2021-08-07--00/c", message(1628294400000, id="c", kmh=3.0))
    run()
    table = spark.read.parquet(f"{tmp_path}/table")
    batch = read_messages(spark, str(raw), VALUE)
    columns = ["id", "kmh", "timestamp", "year", "month", "day"]
    assert rows(table.select(columns)) == rows(batch.rows.select(columns))
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 1


@pytest.fixture
def readings(spark, tmp_path):
    def add(*data):
        spark.createDataFrame(data, READING).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def stream(**options):
        reader = spark.readStream.schema(READING)
        for k, v in options.items():
            reader = reader.option(k, v)
        return rollups.with_event_time(reader.parquet(f"{tmp_path}/in"))

    return add, stream


def test_daily_emits_closed_days_and_drops_late_rows(spark, tmp_path, readings):
    add, stream = readings

    def run():
        daily = rollups.stream_daily(stream(), ("id",), ["kmh"])
        ingest.start_table(daily, f"{tmp_path}/daily", f"{tmp_path}/check").awaitTermination()
        out = spark.read.schema("id string, kmh double, count long, year int, month int, day int").parquet(f"{tmp_path}/daily")
        return {(r["id"], r["day"]): (r["kmh"], r["count"]) for r in rows(out)}

    add(("a", 0, 1.0), ("a", HOUR, 3.0), ("b", 2 * HOUR, 5.0), ("a", DAY + 2 * HOUR, 9.0))
    closed = run()
    assert closed == {("a", 1): (2.0, 2), ("b", 1): (5.0, 1)}
    add(("a", 2 * HOUR, 100.0), ("a", 2 * DAY + 2 * HOUR, 9.0))
    assert run() == {**closed, ("a", 2): (9.0, 1)}


def test_daily_equals_batch_on_closed_days(spark, tmp_path, readings):
    add, stream = readings
    data = [(f"c{i % 5}", i * HOUR, float(i)) for i in range(200)]
    add(*data)
    daily = rollups.stream_daily(stream(), ("id",), ["kmh"], "max")
    ingest.start_table(daily, f"{tmp_path}/daily", f"{tmp_path}/check").awaitTermination()
    expected = {}
    for car, ts, kmh in data:
        if ts // DAY < (data[-1][1] - HOUR) // DAY:
            key = (car, ts // DAY + 1)
            expected[key] = max(kmh, expected.get(key, 0))
    out = spark.read.parquet(f"{tmp_path}/daily")
    assert {(r["id"], r["day"]): r["kmh"] for r in rows(out)} == expected


def test_dedup(spark, tmp_path, readings):
    add, stream = readings
    # not at the very start of the epoch, which Spark's first watermark calls late
    add(("a", DAY, 1.0), ("a", DAY, 2.0), ("b", DAY, 3.0))
    add(("a", DAY, 1.0), ("a", DAY + 5, 4.0))
    once = rollups.stream_dedup(stream(maxFilesPerTrigger=1)).drop(rollups.EVENT_TIME)
    ingest.start_table(once, f"{tmp_path}/out", f"{tmp_path}/check", by=()).awaitTermination()
    got = [(r["id"], r["timestamp"]) for r in rows(spark.read.parquet(f"{tmp_path}/out"))]
    assert sorted(got) == [("a", DAY), ("a", DAY + 5), ("b", DAY)]
    batch = rollups.dedup(spark.read.schema(READING).parquet(f"{tmp_path}/in"))
    assert batch.count() == 3


def test_upserts_replace_documents(spark, tmp_path, readings):
    add, stream = readings

    def run():
        daily = rollups.stream_daily(stream(), ("id",), ["kmh"], "max", watermark="30 days")
        documents.start_upserts(
            daily, ["id", "year", "month", "day"], f"{tmp_path}/log", f"{tmp_path}/check", index="car-max"
        ).awaitTermination()
        out = documents.current_documents(spark, f"{tmp_path}/log", index="car-max")
        return {r["_id"]: json.loads(r["source"])["kmh"] for r in rows(out)}

    add(("a", 0, 1.0), ("b", 0, 2.0))
    assert run() == {"a|1970|1|1": 1.0, "b|1970|1|1": 2.0}
    add(("a", 1, 7.0), ("a", DAY, 3.0))
    assert run() == {"a|1970|1|1": 7.0, "b|1970|1|1": 2.0, "a|1970|1|2": 3.0}
    assert documents.current_documents(spark, f"{tmp_path}/log", index="other").count() == 0


def lines(*values):
    return "\n".join(v if isinstance(v, str) else json.dumps(v) for v in values) + "\n"


def upload(spark, tmp_path, **options):
    files = documents.stream_uploads(spark, f"{tmp_path}/in")
    documents.start_uploads(
        files, f"{tmp_path}/log", f"{tmp_path}/check", f"{tmp_path}/in", **options
    ).awaitTermination()


def current(spark, tmp_path, base=None, index=None):
    out = documents.current_documents(spark, f"{tmp_path}/log", base, index)
    return {(r["_index"], r["_id"]): json.loads(r["source"]) for r in rows(out)}


def test_uploads(spark, tmp_path):
    put(
        tmp_path / "in",
        "folder/my file+1.json",
        lines({"index": {"_id": "1"}}, {"v": 1}, {"delete": {"_id": "9"}}, {"index": {"_id": 2}}, {"delete": {"x": 1}}),
    )
    upload(spark, tmp_path)
    log = documents.logged_actions(spark, f"{tmp_path}/log")
    mine = "folder/my file+1"
    assert {r["_index"] for r in rows(log)} == {mine}
    # a source that looks like an action is still a source
    assert current(spark, tmp_path) == {(mine, "1"): {"v": 1}, (mine, "2"): {"delete": {"x": 1}}}
    put(
        tmp_path / "in",
        "next.json",
        lines(
            {"update": {"_id": "1", "_index": mine}}, {"doc": {"w": 2}}, {"delete": {"_id": "2", "_index": mine}},
            {"index": {"_id": "1"}}, {"v": "next"},
        ),
    )
    upload(spark, tmp_path)
    both = {(mine, "1"): {"v": 1, "w": 2}, ("next", "1"): {"v": "next"}}
    assert current(spark, tmp_path) == both
    assert current(spark, tmp_path, index="next") == {("next", "1"): {"v": "next"}}
    # a compacted base and the rest of the log say the same, index by index
    documents.compact_documents(spark, f"{tmp_path}/log", f"{tmp_path}/base", first=True, buckets=6)
    assert current(spark, tmp_path, f"{tmp_path}/base") == both
    assert current(spark, tmp_path, f"{tmp_path}/base", mine) == {(mine, "1"): {"v": 1, "w": 2}}
    put(tmp_path / "in", "third.json", lines({"index": {"_id": "3"}}, {"v": 3}))
    upload(spark, tmp_path)
    more = {**both, ("third", "3"): {"v": 3}}
    assert current(spark, tmp_path, f"{tmp_path}/base") == more
    documents.compact_documents(spark, f"{tmp_path}/log", f"{tmp_path}/base", trim=True)
    assert current(spark, tmp_path, f"{tmp_path}/base") == more
    # nothing is left of the version before and of the log
    named = rows(store.open_version(spark, f"{tmp_path}/base").manifest)
    assert len(list((tmp_path / "base" / "data").rglob("*.parquet"))) == len(named)
    assert not list((tmp_path / "log").glob("batch=*"))
    put(tmp_path / "in", "fourth.json", lines({"index": {"_id": "3", "_index": "third"}}, {"v": 4}))
    upload(spark, tmp_path)
    assert current(spark, tmp_path, f"{tmp_path}/base") == {**both, ("third", "3"): {"v": 4}}


def test_late_batches_stay_in_order(spark, tmp_path):
    schema = "number long, pair long, op string, _index string, _id string, source string"
    for batch, v in ((8_388_607, 1), (8_388_608, 2), (1 << 40, 3)):
        df = spark.createDataFrame([(1 << 20, 1 << 30, "index", "i", "a", f'{{"v":{v}}}')], schema)
        documents._write_batch(df, batch, f"{tmp_path}/log")
        assert current(spark, tmp_path) == {("i", "a"): {"v": v}}


@pytest.mark.parametrize("bad", ["{oops", "", "5"])
def test_broken_upload(spark, tmp_path, bad):
    put(tmp_path / "in", "good.json", lines({"index": {"_id": "1"}}, {"v": 1}))
    put(tmp_path / "in", "bad.json", lines({"index": {"_id": "2"}}, {"v": 2}, bad))
    with pytest.raises(Exception):
        upload(spark, tmp_path)
    lenient = tmp_path / "lenient"
    lenient.mkdir()
    files = documents.stream_uploads(spark, f"{tmp_path}/in")
    documents.start_uploads(
        files, f"{lenient}/log", f"{lenient}/check", f"{tmp_path}/in", rejects=f"{lenient}/bad"
    ).awaitTermination()
    assert current(spark, lenient) == {("good", "1"): {"v": 1}}
    (reject,) = rows(spark.read.parquet(f"{lenient}/bad"))
    assert reject["file"].endswith("/bad.json") and reject["error"]


def test_same_id_in_two_files_of_a_batch(spark, tmp_path):
    import os

    for n, name in enumerate(["z.json", "a.json"]):
        put(tmp_path / "in", name, lines({"index": {"_id": "1", "_index": "i"}}, {"from": name}))
        os.utime(tmp_path / "in" / name, (1_600_000_000 + n, 1_600_000_000 + n))
    upload(spark, tmp_path)
    assert current(spark, tmp_path) == {("i", "1"): {"from": "a.json"}}


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, "index", None, "a", "{}")], "number long, pair long, op string, _index string, _id string, source string")
    for _ in range(2):
        documents._write_batch(df, 7, f"{tmp_path}/log")
    assert documents.logged_actions(spark, f"{tmp_path}/log").count() == 1


def test_rebuild_touches_only_late_days(spark, tmp_path):
    schema = "id string, year int, month int, day int"
    history = spark.createDataFrame([("a", 2021, 8, d) for d in (6, 6, 7)], schema)
    append_partitioned(group_count(history), f"{tmp_path}/daily")
    untouched = tmp_path / "daily" / "year=2021" / "month=8" / "day=7"
    before = sorted(p.name for p in untouched.iterdir())
    late = spark.createDataFrame([("b", 2021, 8, 6)], schema)
    rollups.rebuild_days(history.unionByName(late), late, group_count, f"{tmp_path}/daily")
    after = spark.read.parquet(f"{tmp_path}/daily")
    assert sorted((r["id"], r["day"], r["count"]) for r in rows(after)) == [("a", 6, 2), ("a", 7, 1), ("b", 6, 1)]
    assert sorted(p.name for p in untouched.iterdir()) == before
