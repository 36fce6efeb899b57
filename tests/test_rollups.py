import math

import pytest
from conftest import rows

from pyspark.sql import functions as F

from roadlog.functions.columns import rename_positional, strip_aggregate_name
from roadlog.operators import emissions, relational, rollups, wear

NAN = float("nan")
KEYS = ["id", "year", "month", "day"]
SCHEMA = "id string, year int, month int, day int, engineHealth double, breakActive boolean, model string"


@pytest.fixture(scope="module")
def cars(spark):
    """Vehicle A has four rows on a day (10 to 6), B two (9 to 8), C one."""
    data = [("A", 2021, 8, 6, v, v > 8, "m1") for v in (10.0, 9.0, 7.0, 6.0)]
    data += [("B", 2021, 8, 6, 9.0, None, "m2"), ("B", 2021, 8, 6, 8.0, False, "m3")]
    data += [("C", 2021, 8, 7, None, False, "m1")]
    return spark.createDataFrame(data, SCHEMA)


def by(df, key, value):
    return {r[key]: r[value] for r in rows(df)}


def test_functions_keep_names(cars):
    for fn, a, b in (("avg", 8.0, 8.5), ("max", 10.0, 9.0), ("min", 6.0, 8.0)):
        got = rollups.rollup(cars, KEYS, ["engineHealth"], fn)
        assert got.columns == KEYS + ["engineHealth"]
        assert by(got, "id", "engineHealth") == {"A": a, "B": b, "C": None}


def test_count_includes_missing_metrics(cars):
    assert by(rollups.group_count(cars), "id", "count") == {"A": 4, "B": 2, "C": 1}
    assert rows(rollups.total_count(cars)) == [{"count": 7}]


def test_nan(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", NAN)], "id string, v double")
    assert math.isnan(by(rollups.rollup(df, ["id"], ["v"], "max"), "id", "v")["x"])
    assert by(rollups.rollup(df, ["id"], ["v"], "avg", nan_as_null=True), "id", "v") == {"x": 1.0}


def test_all_columns(spark, cars):
    with_null_key = cars.unionByName(
        spark.createDataFrame([(None, 2021, 8, 6, 99.0, True, "z")], SCHEMA)
    )
    means = rollups.mean_of_numeric(with_null_key)
    assert set(means.columns) == {*KEYS, "engineHealth", "breakActive"}
    assert by(means, "id", "breakActive") == {"A": 0.5, "B": 0.0, "C": 0.0}
    highs = rollups.max_of_all(with_null_key)
    assert by(highs, "id", "model") == {"A": "m1", "B": "m3", "C": "m1"}
    assert by(highs, "id", "breakActive") == {"A": True, "B": False, "C": False}


def test_share_of_all_rows(cars):
    got = rows(rollups.share_of_total(cars))
    # null and false flags do not count, and vehicles without a match are absent
    assert [(r["id"], r["count"], r["breakingPercentage"]) for r in got] == [("A", 2, 2 / 7)]


def test_share_of_group(cars):
    got = rollups.share_of_total(cars, denominator="group")
    assert by(got, "id", "breakingPercentage") == {"A": 0.5, "B": 0.0, "C": 0.0}
    with pytest.raises(ValueError):
        rollups.share_of_total(cars, denominator="day")


def test_share_counts_add_up(cars):
    assert sum(r["count"] for r in rows(rollups.share_of_total(cars))) == cars.filter("breakActive").count()


def test_empty_table(spark, cars):
    empty = cars.limit(0)
    assert rows(rollups.share_of_total(empty)) == []
    assert rows(wear.wear_rate(empty, KEYS, ["engineHealth"], denominator="groups")) == []
    assert rows(rollups.total_count(empty)) == [{"count": 0}]


def test_trace_and_head(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("b", 1, 2.0), ("a", 2, 3.0)], "id string, timestamp long, lat double")
    assert [r["timestamp"] for r in rows(rollups.vehicle_trace(df, "a", ["timestamp"]), "timestamp")] == [2, 3]
    assert [r["timestamp"] for r in rollups.first_rows(df, 2).collect()] == [1, 2]


def test_names(spark, cars):
    grouped = cars.groupBy("id").max("engineHealth")
    assert strip_aggregate_name(grouped, "max").columns == ["id", "engineHealth"]
    odd = spark.createDataFrame([(1, 2.0)], "`ids` int, `avg(id)` double")
    assert strip_aggregate_name(odd, "avg").columns == ["ids", "id"]
    assert strip_aggregate_name(odd, "max").columns == ["ids", "avg(id)"]
    assert rename_positional(odd, ["a", "b"]).columns == ["a", "b"]


# --- wear ---------------------------------------------------------------------


def test_wear_over_rows(cars):
    got = wear.wear_rate(cars, KEYS, ["engineHealth"])
    assert by(got, "id", "engineHealthDecrease") == {"A": 1.0, "B": 0.5, "C": None}
    mean = wear.period_mean(got, ["year", "month", "day"], ["engineHealthDecrease"])
    assert by(mean, "day", "engineHealthDecrease") == {6: 0.75, 7: None}


def test_wear_over_groups(cars):
    two = cars.filter("id <> 'C'")
    got = wear.wear_rate(two, KEYS, ["engineHealth"], denominator="groups")
    assert by(got, "id", "engineHealthDecrease") == {"A": 2.0, "B": 0.5}
    mean = wear.period_mean(got, ["year", "month", "day"], ["engineHealthDecrease"])
    assert by(mean, "day", "engineHealthDecrease") == {6: 1.25}


@pytest.fixture(scope="module")
def with_null_ids(spark, cars):
    extra = [(None, 2021, 8, 6, v, True, None) for v in (5.0, 1.0)] + [(None, 2021, 9, 1, 3.0, True, None)]
    return cars.unionByName(spark.createDataFrame(extra, SCHEMA))


def test_wear_null_keys(with_null_ids):
    keep = rows(wear.wear_rate(with_null_ids, KEYS, ["engineHealth"]))
    assert sum(r["id"] is None for r in keep) == 2
    drop = rows(wear.wear_rate(with_null_ids, KEYS, ["engineHealth"], null_key_mode="drop"))
    assert sum(r["id"] is None for r in drop) == 0
    split = wear.wear_rate(with_null_ids, KEYS, ["engineHealth"], null_key_mode="split")
    joined = wear.wear_rate_joined(with_null_ids, KEYS, ["engineHealth"])
    assert rows(split) == rows(joined)
    assert sum(r["id"] is None for r in rows(split)) == 6


def test_single_aggregate_equals_join(cars):
    assert rows(wear.wear_rate(cars, KEYS, ["engineHealth"])) == rows(
        wear.wear_rate_joined(cars, KEYS, ["engineHealth"])
    )


def test_wear_from_extremes_equals_groups(cars):
    highs = rollups.rollup(cars, KEYS, ["engineHealth"], "max")
    lows = rollups.rollup(cars, KEYS, ["engineHealth"], "min")
    assert rows(wear.wear_from_extremes(highs, lows, KEYS, ["engineHealth"])) == rows(
        wear.wear_rate(cars, KEYS, ["engineHealth"], denominator="groups")
    )


def test_wear_reads_once(spark, small):
    li = spark.read.parquet(f"{small}/lineitem.parquet")
    single = wear.wear_rate(li, ["l_suppkey"], ["l_tax"])._jdf.queryExecution().executedPlan().toString()
    assert single.count("FileScan") == 1 and single.count("Exchange") == 1
    with pytest.raises(ValueError):
        wear.wear_rate(li, ["l_suppkey"], ["l_tax"], null_key_mode="other")
    with pytest.raises(ValueError):
        wear.wear_rate(li, ["l_suppkey"], ["l_tax"], denominator="other")


# --- joins, unions, emissions -------------------------------------------------


def test_aligned_subtract(spark):
    schema = "k string, v double"
    left = spark.createDataFrame([("a", 5.0), ("b", None), ("c", 1.0), (None, 7.0)], schema)
    right = spark.createDataFrame([("a", 2.0), ("b", None), ("d", 4.0), (None, 1.0)], schema)
    got = by(relational.aligned_subtract(left, right, ["k"], ["v"]), "k", "v")
    assert got == {"a": 3.0, "b": None, "c": 1.0, "d": -4.0, None: 6.0}


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "m int, t string")
    assert relational.union_positional(a, b).count() == 3
    assert rows(relational.union_named(a, b.select(F.col("m").alias("n"))), "n")[-1] == {"n": 2, "s": None}


@pytest.fixture(scope="module")
def fleets(spark):
    eu = spark.createDataFrame([("m1", 6.0, 120.0)], "model string, consumptionKm double, co2Km double")
    usa = spark.createDataFrame(
        [("m1", 16.0, 320.0), ("m2", 8.0, 160.0)], "model string, consumptionMile double, co2Mile double"
    )
    return eu, usa


def test_emission(fleets):
    got = {r["model"]: (r["consumptionKm"], r["co2Km"]) for r in rows(emissions.emission_by_model(*fleets))}
    assert got == {"m1": (8.0, 160.0), "m2": (5.0, 100.0)}
    assert rows(emissions.emission_by_model_joined(*fleets)) == rows(emissions.emission_by_model(*fleets))


def test_emission_null_models(spark, fleets):
    eu, usa = fleets
    eu = eu.unionByName(spark.createDataFrame([(None, 1.0, 2.0)], eu.schema))
    keep = rows(emissions.emission_by_model(eu, usa))
    assert {"model": None, "consumptionKm": 1.0, "co2Km": 2.0} in keep
    split = rows(emissions.emission_by_model(eu, usa, null_key_mode="split"))
    assert split == rows(emissions.emission_by_model_joined(eu, usa)) and len(split) == 4
    assert len(rows(emissions.emission_by_model(eu, usa, null_key_mode="drop"))) == 2


def test_emission_prunes_scans(spark, small):
    li = spark.read.parquet(f"{small}/lineitem.parquet")
    eu = li.selectExpr("l_returnflag model", "l_tax consumptionKm", "l_discount co2Km", "l_quantity other")
    usa = li.selectExpr("l_returnflag model", "l_tax consumptionMile", "l_discount co2Mile", "l_quantity mph")
    plan = emissions.emission_by_model(eu, usa)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<l_discount:double,l_tax:double,l_returnflag:string>") == 2
