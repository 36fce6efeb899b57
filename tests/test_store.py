"""The bucketed document table: what a write touches, what a reader sees."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadlog.operators import keyed, store

DOCS = "_index string, _id string, source string"
ACTIONS = "seq long, op string, _index string, _id string, source string"


def docs_of(spark, n=400):
    return spark.createDataFrame([("a" if i % 2 else "b", f"d{i // 2}", f'{{"v":{i}}}') for i in range(n)], DOCS)


def contents(df):
    return {(r["_index"], r["_id"]): json.loads(r["source"]) for r in rows(df)}


def files(root, version=None):
    base = root / "data"
    return {str(p.relative_to(base)) for p in base.rglob("*.parquet")}


def test_merge_touches_named_buckets_only(spark, tmp_path):
    root = tmp_path / "store"
    first = store.create(docs_of(spark), str(root), 20)
    before = files(root)
    actions = spark.createDataFrame(
        [(1, "update", "a", "d3", '{"doc":{"w":1}}'), (2, "delete", "b", "d5", None), (3, "index", "c", "new", "{}")], ACTIONS
    )
    second = store.merge(spark, str(root), actions)
    new = files(root) - before
    assert before <= files(root) and len(new) <= 3
    touched = {r["bucket"] for r in rows(second.manifest)} - {
        r["bucket"] for r in rows(second.manifest.join(first.manifest, "file", "left_semi"))
    }
    assert len(touched) <= 3
    expected = contents(docs_of(spark))
    # the first version is still what it was
    assert contents(store.scan(first)) == expected
    expected[("a", "d3")]["w"] = 1
    del expected[("b", "d5")]
    expected[("c", "new")] = {}
    assert contents(store.scan(second)) == expected
    assert contents(store.scan(store.open_version(spark, str(root)))) == expected
    assert contents(store.scan(store.open_version(spark, str(root), 0))) == contents(docs_of(spark))
    store.vacuum(spark, str(root))
    assert contents(store.scan(second)) == expected
    assert len(files(root)) == second.manifest.count() < len(before) + len(new)


def test_many_merges_equal_one_apply(spark, tmp_path):
    rnd = random.Random(2)
    acts = []
    for seq in range(120):
        op = rnd.choice(["index", "create", "update", "delete"])
        source = {"update": f'{{"doc":{{"u{seq % 4}":{seq}}}}}', "delete": None}.get(op, f'{{"v":{seq}}}')
        acts.append((seq, op, rnd.choice(["a", "b", None]), f"d{rnd.randint(0, 12)}", source))
    base = docs_of(spark, 12)
    store.create(base, str(tmp_path), 5)
    for part in range(2):
        own = spark.createDataFrame(acts[part * 60 : part * 60 + 60], ACTIONS)
        last = store.merge(spark, str(tmp_path), own, mark=part)
    whole = keyed.apply_actions(base, spark.createDataFrame(acts, ACTIONS)).table
    assert contents(store.scan(last)) == contents(whole)
    assert (last.number, last.mark) == (2, 1)


def test_incomplete_scan_fails(spark, tmp_path):
    root = tmp_path / "store"
    snapshot = store.create(docs_of(spark), str(root), 4)
    assert store.scan(snapshot).count() == 400 and store.missing_files(snapshot, deep=True).count() == 0
    assert store.scan(snapshot, "_index = 'a'").count() == 200
    paths = sorted((root / "data").rglob("*.parquet"))
    # a file with fewer rows under the same name
    spark.read.parquet(str(paths[0])).limit(3).coalesce(1).write.parquet(str(tmp_path / "short"))
    (short,) = (tmp_path / "short").glob("*.parquet")
    kept = paths[0].read_bytes()
    crc = paths[0].with_name(f".{paths[0].name}.crc")
    crc.unlink()
    paths[0].write_bytes(short.read_bytes())
    with pytest.raises(Exception, match="incomplete scan: 1 of the files"):
        store.scan(snapshot).count()
    assert [r["found_rows"] for r in rows(store.missing_files(snapshot))] == [3]
    assert store.scan(snapshot, complete=False).count() < 400
    paths[0].write_bytes(kept)
    assert store.scan(snapshot).count() == 400
    # another file of the same size, found by its checksum
    other = [("a", f"x{i}", "{}") for i in range(spark.read.parquet(str(paths[0])).count())]
    spark.createDataFrame(other, DOCS).coalesce(1).write.parquet(str(tmp_path / "other"))
    (same_size,) = (tmp_path / "other").glob("*.parquet")
    paths[0].write_bytes(same_size.read_bytes())
    assert store.missing_files(snapshot).count() == 0 and store.missing_files(snapshot, deep=True).count() == 1
    paths[0].write_bytes(kept)
    # a removed file beside others, and a file that no manifest names
    extra = paths[1].with_name("part-extra.parquet")
    extra.write_bytes(kept)
    with pytest.raises(Exception, match="incomplete scan"):
        store.scan(snapshot).count()
    paths[1].unlink()
    paths[1].with_name(f".{paths[1].name}.crc").unlink()
    assert store.missing_files(snapshot).count() == 2
    with pytest.raises(Exception, match="incomplete scan: 2 of the files"):
        store.scan(snapshot).count()


def files_read(df):
    """How many files the scan of a plan opens."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        df.sparkSession.createDataFrame([], "x int").count()
        plan.executeCollect()
        leaves = plan.collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        scans = [x for x in found if "FileScan" in x.simpleString(100)]
        return [x.metrics().apply("numFiles").value() for x in scans], [x.metrics().apply("numOutputRows").value() for x in scans]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_lookup_reads_buckets_of_the_ids(spark, tmp_path):
    snapshot = store.create(docs_of(spark, 4000), str(tmp_path), 16)
    asked = spark.createDataFrame([("a", "d7"), ("b", "d7"), ("c", "d7"), ("a", "d7"), (None, "d7"), ("a", None)], "_index string, _id string")
    got = [(r["_index"], r["_id"], r["source"], r["found"]) for r in rows(store.lookup(snapshot, asked))]
    assert sorted(got, key=str) == sorted(
        [("a", "d7", '{"v":15}', True)] * 2 + [("b", "d7", '{"v":14}', True)]
        + [("c", "d7", None, False), ("", "d7", None, False), ("a", None, None, False)], key=str,
    )
    assert sum(r["found"] for r in rows(store.exists(snapshot, asked))) == 3
    one = spark.createDataFrame([("a", "d7")], "_index string, _id string")
    hits = store.documents(snapshot, store.touched_buckets(one, 16)).filter(F.col("_id").isin(["d7"]))
    n_files, _ = files_read(hits)
    assert n_files == [1]
    assert store.lookup(snapshot, asked.limit(0)).count() == 0


def test_empty_tables(spark, tmp_path):
    snapshot = store.create(spark.createDataFrame([], DOCS), str(tmp_path), 3)
    assert store.scan(snapshot).count() == 0
    one = spark.createDataFrame([(1, "index", None, None, "{}"), (2, "delete", None, None, None)], ACTIONS)
    after = store.merge(spark, str(tmp_path), one)
    assert store.scan(after).count() == 1
    assert store.scan(store.merge(spark, str(tmp_path), one.limit(0))).count() == 1
    gone = store.scan(after).select(F.lit(1).alias("seq"), F.lit("delete").alias("op"), "_index", "_id", F.lit(None).cast("string").alias("source"))
    assert store.scan(store.merge(spark, str(tmp_path), gone)).count() == 0
    with pytest.raises(ValueError):
        store.open_version(spark, str(tmp_path), 77)
