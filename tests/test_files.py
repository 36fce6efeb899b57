import datetime as dt
import gzip
import json
import os

import pytest
from conftest import rows

from pyspark.sql import functions as F

from roadlog import schemas, workspace
from roadlog.functions.calendar import date_range, with_calendar, with_date
from roadlog.functions.columns import index_from_file_path, index_from_object_key
from roadlog.plans import daily_summary, fleet_reports, raw_ingest, wear_report
from roadlog.plans.common import write_outputs
from roadlog.session import build_session, object_store_conf, sized_conf
from roadlog.sinks import tables
from roadlog.sources import files


def test_quoted_csv(spark, tmp_path):
    (tmp_path / "q.csv").write_text('n,s\n1,"say ""hi"", ok"\n2,"two\nlines"\n3,plain\n')
    got = rows(files.read_csv(spark, str(tmp_path / "q.csv"), "n int, s string"), "n")
    assert [(r["n"], r["s"]) for r in got] == [(1, 'say "hi", ok'), (2, "two\nlines"), (3, "plain")]
    (tmp_path / "bad.csv").write_text("n,s\nx,y\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), "n int, s string").collect()


def test_json_lines_with_rejects(spark, tmp_path):
    (tmp_path / "l").write_text('{"a":1,"b":2}\n{"a":"x","b":3}\n{oops\n\n[1]\n{"b":4}\n')
    checked = files.checked_json_lines(spark, str(tmp_path / "l"), "a long, b long")
    assert [(r["a"], r["b"]) for r in rows(checked.rows, "b")] == [(1, 2), (None, 3), (None, 4)]
    for columns in (["a"], ["b"], ["a", "b"]):
        assert len(checked.rows.select(*columns).collect()) == checked.rows.count() == 3
    reasons = {r["value"]: r["reason"] for r in rows(checked.rejects)}
    assert reasons == {'{"a":"x","b":3}': "schema mismatch", "{oops": "malformed", "[1]": "malformed"}
    assert files.read_any(spark, str(tmp_path / "l"), "json_lines").count() == 3


def test_summary_reads_its_table_once(spark, tmp_path):
    table = spark.createDataFrame([("a", 1)], "id string, v int")
    outputs = daily_summary.daily_summary_all_columns(table.selectExpr("*", "1 as year", "2 as month", "3 as day", "4L as timestamp", "0d as lat", "0d as lon"), "a")
    plan = outputs["car-max"].rows._jdf.queryExecution().executedPlan().toString()
    # what the sinks read is a table, not the aggregate
    assert "FileScan" in plan and "Aggregate" not in plan


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "é")], "n int, s string")
    df.write.csv(f"{tmp_path}/csv", header=True)
    df.write.parquet(f"{tmp_path}/parquet")
    df.write.json(f"{tmp_path}/lines")
    os.mkdir(tmp_path / "json")
    (tmp_path / "json" / "one.json").write_text('[\n{"n": 1, "s": "x"},\n{"n": 2,\n "s": "é"}]', encoding="utf-8")
    for fmt, name in (("csv", "csv"), ("parquet", "parquet"), ("json_lines", "lines"), ("json", "json")):
        assert rows(files.read_any(spark, f"{tmp_path}/{name}", fmt).select("n", "s"), "n") == rows(df, "n")
        assert rows(files.read_any(spark, f"{tmp_path}/{name}", fmt, df.schema), "n") == rows(df, "n")
    with pytest.raises(ValueError, match="unknown format"):
        files.read_any(spark, str(tmp_path), "xml")


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":{"b":1}}\n{oops\nnull\n\n5\n')
    docs = files.read_json_lines(spark, str(tmp_path))
    assert sorted(r.j for r in docs.select(F.to_json("doc").alias("j")).collect()) == ["5", '{"a":{"b":1}}']
    table = files.read_json_lines_table(spark, str(tmp_path), paths=["a.b"], date=dt.date(2021, 8, 6))
    assert {"a.b": "1", "year": 2021, "month": 8, "day": 6} in rows(table)
    with pytest.raises(ValueError):
        files.read_json_lines_table(spark, str(tmp_path))


def test_json_documents(spark, tmp_path):
    (tmp_path / "a").write_text('{\n "x": 1\n}')
    (tmp_path / "b").write_text("{'x':\n None}")
    (tmp_path / "c").write_text("{")
    got = files.read_json_documents(spark, str(tmp_path))
    out = {r.file[-1]: (r.decode_path, r.j) for r in got.select("file", "decode_path", F.to_json("doc").alias("j")).collect()}
    assert out == {"a": ("json", '{"x":1}'), "b": ("literal", '{"x":null}'), "c": ("failed", "{}")}


def test_types_of_json_documents(spark, tmp_path):
    """Types come from all files, read as texts; other encodings are left to Spark."""
    at = tmp_path / "docs"
    at.mkdir()
    (at / "a.json").write_text('[{"n":1,"s":"x"},\n {"n":2.5,"l":[{"k":1}]}]')
    (at / "b.json").write_text('{"n":3,\n"s":null,"o":{"é":true}}', encoding="utf-8")
    (at / "c.json").write_text("")
    with gzip.open(at / "d.json.gz", "wt") as f:
        f.write('[{"n":4,"late":"2024-01-01"}]')
    own = spark.read.option("multiLine", "true").json(str(at))
    got = files.read_any(spark, str(at), "json")
    assert got.schema == own.schema and rows(got) == rows(own)
    options = {"multiLine": "true", "mode": "FAILFAST"}
    assert files._documents_schema(spark, str(at), options) == own.schema
    (tmp_path / "wide.json").write_bytes('[{"n":1},{"n":2}]'.encode("utf-16-le"))
    assert files._documents_schema(spark, str(tmp_path / "wide.json"), options) is None
    assert [r["n"] for r in rows(files.read_any(spark, str(tmp_path / "wide.json"), "json"), "n")] == [1, 2]
    (tmp_path / "broken.json").write_text('[{"n":1}')
    with pytest.raises(Exception):
        files.read_any(spark, str(tmp_path / "broken.json"), "json").collect()


def test_csv_to_parquet(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,s\n1,x\n")
    (tmp_path / "empty.csv").write_text("n,s\n")
    assert tables.csv_to_parquet(spark, f"{tmp_path}/a.csv", f"{tmp_path}/p")
    assert rows(spark.read.parquet(f"{tmp_path}/p")) == [{"n": 1, "s": "x"}]
    assert not tables.csv_to_parquet(spark, f"{tmp_path}/empty.csv", f"{tmp_path}/q", "n int, s string")


def test_partitioned_append_and_replace(spark, tmp_path):
    df = spark.createDataFrame([("a", 2021, 8, 6), ("b", None, 8, 7)], "id string, year int, month int, day int")
    for _ in range(2):
        tables.append_partitioned(df, f"{tmp_path}/append")
        tables.append_partitioned(df, f"{tmp_path}/replace", replace_touched=True)
    assert files.read_table(spark, f"{tmp_path}/append").count() == 4
    back = files.read_table(spark, f"{tmp_path}/replace")
    assert rows(back, "id") == rows(df, "id")
    assert dict(back.dtypes)["year"] == "int"


def test_text_and_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "n int, s string")
    tables.write_json_lines(df, f"{tmp_path}/new/deep")
    tables.write_json_lines(df, f"{tmp_path}/new/deep")
    assert spark.read.text(f"{tmp_path}/new/deep").count() == 4
    tables.write_text(df, f"{tmp_path}/text", "n")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/text").collect()) == ["1", "2"]


def test_bulk_pairs_stay_together(spark, tmp_path):
    df = spark.range(1000).repartition(7)
    tables.write_bulk_file(df, f"{tmp_path}/bulk", ["id"])
    seen = 0
    for name in os.listdir(tmp_path / "bulk"):
        if name.startswith("part-"):
            lines = [json.loads(x) for x in (tmp_path / "bulk" / name).read_text().splitlines()]
            for action, source in zip(lines[::2], lines[1::2], strict=True):
                assert action == {"index": {"_id": str(source["id"])}}
                seen += 1
    assert seen == 1000


def test_calendar(spark):
    df = spark.createDataFrame([(1628233200123,), (-1,), (None,)], "timestamp long")
    got = [(r["year"], r["month"], r["day"]) for r in with_calendar(df).collect()]
    assert got == [(2021, 8, 6), (1969, 12, 31), (None, None, None)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [(r["year"], r["month"], r["day"]) for r in with_calendar(df).collect()] == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert with_date(df, None).columns == ["timestamp"]
    days = spark.createDataFrame([(2021, 12, 31), (2022, 1, 1), (2022, 1, 5)], "year int, month int, day int")
    assert date_range(days, dt.date(2021, 12, 31), dt.date(2022, 1, 1)).count() == 2


@pytest.mark.parametrize(
    "key, index",
    [
        ("folder/my+file%2Fpart.json", "folder/my file/part"),
        ("x.y/b.tar.gz", "x.y/b.tar"),
        ("x.y/b", "x.y/b"),
        (".hidden", ".hidden"),
        ("a/.hidden.txt", "a/.hidden"),
        ("a..b", "a."),
        ("..a", "..a"),
        ("a" + "." * 70 + "txt", "a" + "." * 69),
        ("a/" + "." * 70 + "txt", "a/" + "." * 70 + "txt"),
        ("two%0Alines.txt", "two\nlines"),
    ],
)
def test_index_names(spark, key, index):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(index_from_object_key(F.col("k"))).first()[0] == index
    assert os.path.splitext(__import__("urllib.parse").parse.unquote_plus(key))[0] == index


def test_index_of_file(spark, tmp_path):
    os.mkdir(tmp_path / "my dir")
    (tmp_path / "my dir" / "a+b.json").write_text("x")
    paths = spark.read.text(f"{tmp_path}/my dir").select(F.col("_metadata.file_path").alias("p"))
    assert paths.select(index_from_file_path(F.col("p"), str(tmp_path))).first()[0] == "my dir/a+b"
    assert paths.select(index_from_file_path(F.col("p"), f"file://{tmp_path}")).first()[0] == "my dir/a+b"


def test_session_settings(spark):
    conf = object_store_conf(packages="org.apache.hadoop:hadoop-aws:3.4.1", endpoint="http://localhost:1")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://localhost:1" and "spark.jars.packages" in conf
    assert sized_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert sized_conf(10 << 40)["spark.sql.shuffle.partitions"] == "81920"
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_workspace(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x").startswith(folder)
    kept = workspace.written(spark.range(3))
    assert kept.count() == 3 and kept.inputFiles()[0].startswith("file://")


# --- the analyses -------------------------------------------------------------

MESSAGES = [
    {"timestamp": 1628233200000 + i * 1000, "value": {"id": v, "model": "m1", "kmh": k, "breakActive": b, "engineHealth": h}}
    for i, (v, k, b, h) in enumerate([("a", 10.0, True, 9.0), ("a", 20.0, False, 7.0), ("b", 30.0, False, 5.0)])
]


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("ingest")
    (root / "raw").mkdir()
    (root / "raw" / "messages").write_text("\n".join(map(json.dumps, MESSAGES)) + "\n{oops\n")
    rejects = raw_ingest.ingest_messages(spark, f"{root}/raw", f"{root}/table", f"{root}/sample", sample_rows=2, sample_order=["timestamp"])
    return root, rejects


def test_ingest(spark, ingested):
    root, rejects = ingested
    assert [r["reason"] for r in rows(rejects)] == ["malformed"]
    table = files.read_table(spark, f"{root}/table", schemas.EU_TABLE)
    assert table.count() == 3 and {(r["year"], r["month"], r["day"]) for r in rows(table)} == {(2021, 8, 6)}
    sample = [x for p in (root / "sample").glob("part-*") for x in p.read_text().splitlines()]
    assert [json.loads(x) for x in sample[::2]] == [
        {"index": {"_id": f"a|{m['timestamp']}"}} for m in MESSAGES[:2]
    ]


def test_summary_outputs(spark, ingested):
    root, _ = ingested
    table = files.read_table(spark, f"{root}/table", schemas.EU_TABLE)
    outputs = daily_summary.daily_summary(table, "a")
    write_outputs(outputs, f"{root}/out", f"{root}/bulk")
    avg = {r["id"]: r["kmh"] for r in rows(spark.read.parquet(f"{root}/out/car-avg"))}
    assert avg == {"a": 15.0, "b": 30.0}
    assert {r["id"]: r["kmh"] for r in rows(spark.read.parquet(f"{root}/out/car-max"))} == {"a": 20.0, "b": 30.0}
    assert spark.read.parquet(f"{root}/out/car-pos").count() == 2
    assert [(r["id"], r["count"], r["breakingPercentage"]) for r in rows(outputs["car-breaking"].rows)] == [("a", 1, 1 / 3)]
    lines = [x for p in (root / "bulk" / "car-breaking").glob("part-*") for x in p.read_text().splitlines()]
    assert json.loads(lines[0]) == {"index": {"_id": "a|2021|8|6"}}
    every = daily_summary.daily_summary_all_columns(table, "a")
    assert {r["id"]: r["engineHealth"] for r in rows(every["car-max"].rows)} == {"a": 9.0, "b": 5.0}


def test_wear_outputs(spark, ingested):
    root, _ = ingested
    table = files.read_table(spark, f"{root}/table", schemas.EU_TABLE)
    report = wear_report.wear_report(table)
    assert {r["id"]: r["engineHealth"] for r in rows(report["wearing-parts-car"].rows)} == {"a": 9.0, "b": 5.0}
    assert {r["id"]: r["engineHealth"] for r in rows(report["wearing-parts-car"].documents)} == {"a": 7.0, "b": 5.0}
    assert rows(report["wearing-parts-decrease"].rows)[0]["engineHealthDecrease"] == 0.5
    raw = wear_report.wear_report(table, raw_names=True)
    assert "max(engineHealth)" in raw["wearing-parts-car"].rows.columns
    assert "avg(engineHealthDecrease)" in raw["wearing-parts-decrease"].rows.columns
    over = wear_report.wear_report_over_groups(table)["wearing-parts-decrease"].rows
    assert rows(over)[0]["engineHealth"] == 0.5


def test_fleet_outputs(spark):
    usa = spark.createDataFrame([("m", 16.0, 32.0, 90.0)], "model string, consumptionMile double, co2Mile double, mph double")
    eu = spark.createDataFrame([("m", 20.0, 40.0)], "model string, consumptionKm double, co2Km double")
    assert rows(fleet_reports.emission_report(eu, usa)["consumption-emission"].rows) == [
        {"model": "m", "consumptionKm": 15.0, "co2Km": 30.0}
    ]
    stats = fleet_reports.model_report(usa)
    assert rows(stats["mph-max-usa"].rows) == [{"model": "m", "mph": 90.0}]
    assert rows(stats["mile-avg-usa"].rows) == [{"model": "m", "consumptionMile": 16.0}]


def test_task_functions_travel_with_the_job(tmp_path):
    """A worker that cannot import the package can still run its functions."""
    import subprocess
    import sys

    import numpy as np
    from pyspark import cloudpickle

    from roadlog.operators import bulk

    (tmp_path / "f").write_bytes(cloudpickle.dumps((bulk.chunk_bounds, np.array([3, 3, 3]))))
    code = "import pickle, sys; f, sizes = pickle.load(open('f', 'rb')); print(f(sizes, 500, 6), 'roadlog' in sys.modules)"
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split("\n")[0] == "[0, 2] False"
