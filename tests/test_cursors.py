"""Pages by cursor, and parts of documents by path."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadlog.functions.paths import PathFilter, project_paths
from roadlog.operators import cursors, search

SORT = ["a:desc", "b", "k"]


def data(n=300):
    rnd = random.Random(6)
    return [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y", "é"]), i) for i in range(n)]


def in_order(values):
    return sorted(values, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, (r[1] or "").encode(), r[2]))


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cursor") / "t")
    cursors.write_ordered(spark.createDataFrame(data(), "a int, b string, k int").repartition(3), path, SORT, 20)
    return path


def test_every_row_once(spark, ordered):
    found = [[tuple(r) for r in p.collect()] for p in cursors.pages(spark, ordered, SORT, 45)]
    assert [r for p in found for r in p] == in_order(data())
    assert {len(p) for p in found[:-1]} == {45}


def test_all_pages_in_one_table(spark, ordered):
    for size, predicate in ((45, None), (7, "k % 3 = 1"), (1000, None), (5, "k > 1000")):
        hits = [r for r in in_order(data()) if predicate is None or predicate[:5] == "k % 3" and r[2] % 3 == 1]
        got = cursors.pages(spark, ordered, SORT, size, predicate).numbered()
        assert got.columns == ["page", "a", "b", "k"]
        assert {tuple(r) for r in got.collect()} == {(i // size + 1, *r) for i, r in enumerate(hits)}
        assert got.count() == len(hits)


def test_numbered_pages_of_nothing(spark, tmp_path):
    cursors.write_ordered(spark.createDataFrame([], "a int, b string, k int"), f"{tmp_path}/t", SORT)
    assert cursors.pages(spark, f"{tmp_path}/t", SORT).numbered().count() == 0


def test_page_after_any_row(spark, ordered):
    everything = in_order(data())
    for at in (0, 7, 150, 298, 299):
        got = cursors.page(spark, ordered, SORT, list(everything[at]), 9).collect()
        assert [tuple(r) for r in got] == everything[at + 1 : at + 10]
    odd = [r for r in everything if r[2] % 7 == 3]
    got = cursors.page(spark, ordered, SORT, list(odd[2]), 12, "k % 7 = 3", ["k"]).collect()
    assert [r.k for r in got] == [r[2] for r in odd[3:15]]
    assert cursors.page(spark, ordered, SORT, None, 5, "k > 1000").count() == 0
    with pytest.raises(ValueError, match="3 values"):
        cursors.page(spark, ordered, SORT, [1], 5)


def test_cursor_reaches_the_scan(spark, ordered):
    page = cursors.page(spark, ordered, SORT, [2, "x", 100], 10)
    plan = page._jdf.queryExecution().explainString(page._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "LessThan(a,2)" in pushed and "GreaterThan(k,100)" in pushed
    # a page in the middle reads a file or two of the sixteen
    assert len(page.inputFiles()) <= 2


def test_nothing_to_page(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, b string, k int")
    cursors.write_ordered(empty, f"{tmp_path}/t", SORT)
    assert list(cursors.pages(spark, f"{tmp_path}/t", SORT)) == []


DOC = {"a": {"b": 1, "c": {"d": "x", "e": None}}, "l": [{"b": 1, "z": 2}, 7, [{"b": 3}]], "ab": 1.50, "o": {}, "n": [1, 2]}


@pytest.mark.parametrize(
    "includes, excludes, expected",
    [
        ([], [], DOC),
        (["a"], [], {"a": DOC["a"]}),
        (["a.b"], [], {"a": {"b": 1}}),
        (["a*"], [], {"a": DOC["a"], "ab": 1.5}),
        (["*.b"], [], {"a": {"b": 1}, "l": [{"b": 1}, [{"b": 3}]]}),
        (["l.b", "n"], [], {"l": [{"b": 1}, [{"b": 3}]], "n": [1, 2]}),
        (["a.c.d", "nothing"], [], {"a": {"c": {"d": "x"}}}),
        (["o"], [], {"o": {}}),
        (["o.x"], [], {}),
        ([], ["a.c", "l"], {"a": {"b": 1}, "ab": 1.5, "o": {}, "n": [1, 2]}),
        (["a"], ["a.b", "*.e"], {"a": {"c": {"d": "x"}}}),
        (["a"], ["*"], {}),
    ],
)
def test_paths(includes, excludes, expected):
    assert json.loads(PathFilter(includes, excludes)(json.dumps(DOC))) == expected


def test_paths_of_sources(spark):
    df = spark.createDataFrame([(1, '{"v":1.50,"w":{"x":1e3}}'), (2, None), (3, "[1]")], "_id int, source string")
    got = search.search_page(df, sort=["_id"], source_includes=["v", "w.x"]).collect()
    assert [r.source for r in got] == ['{"v":1.50,"w":{"x":1e3}}', None, "[1]"]
    assert df.select(project_paths(F.col("source"), [], ["w"]).alias("s")).first().s == '{"v":1.50}'
