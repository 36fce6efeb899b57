import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadlog import schemas
from roadlog.sources import messages
from roadlog.sources.messages import read_hour_buckets, read_messages, require_envelopes

VALUE = "id STRING, model STRING, kmh DOUBLE, breakActive BOOLEAN, timestamp LONG"
GOOD = '{"timestamp":1628233200123,"value":{"id":"a","model":"m1","kmh":50.5,"breakActive":true}}'


@pytest.fixture
def value_schema():
    from pyspark.sql import types as T

    return T.StructType.fromDDL(VALUE)


def write(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_unwrap_and_calendar(spark, tmp_path, value_schema):
    write(tmp_path, "one", GOOD)
    (row,) = rows(read_messages(spark, str(tmp_path), value_schema).rows)
    assert row == {
        "id": "a", "model": "m1", "kmh": 50.5, "breakActive": True,
        "timestamp": 1628233200123, "year": 2021, "month": 8, "day": 6, "extra": None,
    }


def test_zone_moves_the_day(spark, tmp_path, value_schema):
    # 2021-08-06 07:00 UTC is still the 5th twelve hours west
    write(tmp_path, "one", GOOD)
    (row,) = rows(read_messages(spark, str(tmp_path), value_schema, tz="Etc/GMT+12").rows)
    assert (row["year"], row["month"], row["day"]) == (2021, 8, 5)


def test_envelope_timestamp_wins(spark, tmp_path, value_schema):
    write(tmp_path, "one", '{"timestamp":5,"value":{"id":"a","timestamp":99}}')
    (row,) = rows(read_messages(spark, str(tmp_path), value_schema).rows)
    assert row["timestamp"] == 5 and row["year"] == 1970


REJECTED = {
    '{"timestamp":5,"value":{"id":"a","kmh":5': "malformed",
    '{"timestamp":5,"value":{"id":"a"},"more': "malformed",
    "{oops": "malformed",
    "12": "not an envelope",
    "null": "null",
    "[1]": "not an envelope",
    '{"value":{"id":"a"}}': "missing value or timestamp",
    '{"timestamp":5}': "missing value or timestamp",
    '{"timestamp":"soon","value":{"id":"a"}}': "missing value or timestamp",
    '{"timestamp":5,"value":7}': "missing value or timestamp",
}


def test_rejects_with_reason(spark, tmp_path, value_schema):
    write(tmp_path, "bad", "\n".join([GOOD, "", *REJECTED, "   "]))
    read = read_messages(spark, str(tmp_path), value_schema)
    assert len(rows(read.rows)) == 1
    assert {r["token"]: r["reason"] for r in rows(read.rejects)} == REJECTED
    assert all(r["file"].endswith("/bad") for r in rows(read.rejects))


def test_nan_and_repeated_keys_are_accepted(spark, tmp_path, value_schema):
    write(tmp_path, "odd", '{"timestamp":5,"value":{"id":"a","kmh":NaN}}\n{"timestamp":1,"timestamp":2,"value":{"id":"b"}}')
    got = rows(read_messages(spark, str(tmp_path), value_schema).rows, "id")
    assert [r["id"] for r in got] == ["a", "b"]
    assert got[0]["kmh"] != got[0]["kmh"] and got[1]["timestamp"] == 2


def extras(df):
    return [r["extra"] and json.loads(r["extra"]) for r in rows(df.withColumn("extra", F.to_json("extra")), "id")]


def test_fields_without_a_column_are_kept(spark, tmp_path, value_schema):
    write(
        tmp_path,
        "open",
        "\n".join(
            [
                '{"timestamp":1,"value":{"id":"a","kmh":"fast","model":"m"}}',
                '{"timestamp":1,"value":{"id":"b","new":{"x":[1,{"y":2}]},"none":null,"kmh":3}}',
                '{"timestamp":1,"value":{"id":"c","timestamp":4,"year":5,"kmh":null}}',
                '{"timestamp":1,"value":{"id":"d","breakActive":"yes","kmh":1.5}}',
            ]
        ),
    )
    read = read_messages(spark, str(tmp_path), value_schema)
    assert extras(read.rows) == [{"kmh": "fast"}, {"new": {"x": [1, {"y": 2}]}, "none": None}, None, {"breakActive": "yes"}]
    assert [r["kmh"] for r in rows(read.rows, "id")] == [None, 3.0, None, 1.5]
    assert read.rejects.count() == 0
    slim = read_messages(spark, str(tmp_path), value_schema, extra=False).rows
    assert "extra" not in slim.columns and slim.count() == 4


@pytest.mark.parametrize("number, milliseconds", [("1628233200123.0", 1628233200123), ("1.5e3", 1500), ("-1", -1), ("7.9", 7)])
def test_numbers_of_any_spelling(spark, tmp_path, value_schema, number, milliseconds):
    write(tmp_path, "one", f'{{"timestamp":{number},"value":{{"id":"a"}}}}')
    (row,) = rows(read_messages(spark, str(tmp_path), value_schema).rows)
    assert row["timestamp"] == milliseconds


@pytest.mark.parametrize("blank", [" ", "\t", "\u00a0", "\x1c", "\u2003", "\r"])
def test_blanks_around_a_line(spark, tmp_path, value_schema, blank):
    write(tmp_path, "one", f"{blank}{GOOD}{blank}{blank}")
    read = read_messages(spark, str(tmp_path), value_schema)
    assert read.rows.count() == 1 and read.rejects.count() == 0


def test_one_pass_gives_rows_and_rejects(spark, tmp_path, value_schema):
    write(tmp_path, "in/mixed", "\n".join([GOOD, *REJECTED, GOOD]))
    once = read_messages(spark, f"{tmp_path}/in", value_schema, once=True)
    # the files are not needed any more
    (tmp_path / "in" / "mixed").write_text("")
    assert once.rows.count() == 2
    assert {r["token"]: r["reason"] for r in rows(once.rejects)} == REJECTED
    for side in once:
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(_usable" in plan
    assert require_envelopes(read_messages(spark, f"{tmp_path}/in", value_schema, once=True)).count() == 0


def test_framing(spark, tmp_path, value_schema):
    spaced = GOOD.replace("m1", "m 1")
    # two messages on one line, separated by a no-break space
    write(tmp_path, "framed", f"{GOOD} {GOOD}\n{spaced}\n")
    tokens = read_messages(spark, str(tmp_path), value_schema, framing="tokens")
    assert [r["model"] for r in rows(tokens.rows)] == ["m1", "m1"]
    assert len(rows(tokens.rejects)) == 2
    lines = read_messages(spark, str(tmp_path), value_schema, framing="lines")
    assert "m 1" in [r["model"] for r in rows(lines.rows)]
    with pytest.raises(ValueError):
        read_messages(spark, str(tmp_path), value_schema, framing="words")


@pytest.mark.parametrize("separator", [" ", "\t", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", " ", " ", " "])
def test_every_separator(spark, tmp_path, value_schema, separator):
    write(tmp_path, "framed", separator.join([GOOD, GOOD]))
    got = read_messages(spark, str(tmp_path), value_schema, framing="tokens").rows
    assert got.count() == 2


def test_recursion_and_buckets(spark, tmp_path, value_schema):
    write(tmp_path, "car/2021-08-06--07/part-0", GOOD)
    write(tmp_path, "car/2021-08-06--08/deep/part-0", GOOD + "\n" + GOOD)
    got = rows(read_hour_buckets(spark, [str(tmp_path)], value_schema))
    assert sorted(r["bucket"] for r in got) == ["2021-08-06--07", "2021-08-06--08", "2021-08-06--08"]
    write(tmp_path, "flat", GOOD)
    assert read_messages(spark, str(tmp_path) + "/flat", value_schema, recursive=False).rows.count() == 1


def test_strict_envelopes(spark, tmp_path, value_schema):
    write(tmp_path, "skips", GOOD + "\n{oops\nnull")
    read = read_messages(spark, str(tmp_path), value_schema)
    assert require_envelopes(read).count() == 1
    write(tmp_path, "fails", "12")
    with pytest.raises(Exception, match="not an envelope"):
        require_envelopes(read_messages(spark, str(tmp_path), value_schema)).collect()


def test_one_stage_without_shuffle(spark, tmp_path, value_schema):
    write(tmp_path, "one", GOOD)
    plan = read_messages(spark, str(tmp_path), value_schema).rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_json") == 1


def test_default_schemas():
    assert set(schemas.DAILY_METRICS) < set(schemas.EU_TABLE.fieldNames())
    assert schemas.USA_TABLE.fieldNames()[-4:] == ["timestamp", "year", "month", "day"]
    assert messages.HOUR_BUCKET
