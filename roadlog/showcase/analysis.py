"""Rollups, wear and emissions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadlog.functions import calendar
from roadlog.functions.columns import convert_units, rename_positional, strip_aggregate_name
from roadlog.operators import emissions, relational, rollups, wear
from roadlog.schemas import CALENDAR, HEALTH_METRICS, KM_PER_MILE, TRACE_COLUMNS, VEHICLE_DAY
from roadlog.showcase.registry import query
from roadlog.showcase.views import (
    EVENT_METRICS,
    FLEETS,
    LINE_KEYS,
    TELE_EVENTS,
    TELE_LINE,
    eu_fleet,
    table,
    tele_events,
    tele_line,
    usa_fleet,
)

# the vehicle whose trace is shown
TRACED = 7
DECREASES = [f"{m}Decrease" for m in HEALTH_METRICS]


def _each(fmt: str, names) -> str:
    return ", ".join(fmt.format(m=m) for m in names)


def _daily_sql(fn: str) -> str:
    return (
        f"WITH {TELE_EVENTS} SELECT id, year, month, day, {_each(fn + '({m}) AS {m}', EVENT_METRICS)} "
        "FROM tele_events GROUP BY id, year, month, day"
    )


# --- daily rollups ------------------------------------------------------------


@query(_daily_sql("avg"))
def daily_avg(spark, folder):
    return rollups.rollup(tele_events(spark, folder), VEHICLE_DAY, EVENT_METRICS, "avg")


@query(_daily_sql("max"))
def daily_max(spark, folder):
    return rollups.rollup(tele_events(spark, folder), VEHICLE_DAY, EVENT_METRICS, "max")


@query(_daily_sql("min"))
def daily_min(spark, folder):
    return rollups.rollup(tele_events(spark, folder), VEHICLE_DAY, EVENT_METRICS, "min")


@query(
    f"WITH {TELE_EVENTS} SELECT id, year, month, day, count(*) AS count FROM tele_events GROUP BY id, year, month, day"
)
def daily_count(spark, folder):
    return rollups.group_count(tele_events(spark, folder), VEHICLE_DAY)


@query(f"WITH {TELE_EVENTS} SELECT count(*) AS count FROM tele_events")
def total_count(spark, folder):
    return rollups.total_count(tele_events(spark, folder))


@query(_daily_sql("max"))
def aggregate_name_cleanup(spark, folder):
    grouped = tele_events(spark, folder).groupBy(*VEHICLE_DAY).max(*EVENT_METRICS)
    return strip_aggregate_name(grouped, "max")


# longitude and latitude are not whole numbers: their means are rounded
@query(
    f"""WITH {TELE_EVENTS}
SELECT id, year, month, day, avg(timestamp) AS timestamp, avg(kmh) AS kmh, avg(rpm) AS rpm,
  round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, avg(CAST(breakActive AS INTEGER)) AS breakActive
FROM tele_events GROUP BY id, year, month, day"""
)
def all_numeric_mean(spark, folder):
    means = rollups.mean_of_numeric(tele_events(spark, folder), VEHICLE_DAY)
    return means.withColumns({c: F.round(c, 6) for c in ("lat", "lon")})


@query(
    f"""WITH {TELE_EVENTS}
SELECT id, year, month, day, max(timestamp) AS timestamp, max(model) AS model, max(kmh) AS kmh, max(rpm) AS rpm,
  max(lat) AS lat, max(lon) AS lon, max(breakActive) AS breakActive
FROM tele_events GROUP BY id, year, month, day"""
)
def all_column_max(spark, folder):
    return rollups.max_of_all(tele_events(spark, folder), VEHICLE_DAY)


@query(
    f"""WITH {TELE_LINE}
SELECT id, year, month, count(*) AS count, count(*) / (SELECT count(*) FROM tele_line) AS breakingPercentage
FROM tele_line WHERE breakActive GROUP BY id, year, month"""
)
def breaking_share(spark, folder):
    return rollups.share_of_total(tele_line(spark, folder), LINE_KEYS, "breakActive")


@query(
    f"""WITH {TELE_LINE}
SELECT id, year, month, count(*) FILTER (WHERE breakActive) AS count,
  count(*) FILTER (WHERE breakActive) / count(*) AS breakingPercentage
FROM tele_line GROUP BY id, year, month"""
)
def breaking_share_group(spark, folder):
    return rollups.share_of_total(tele_line(spark, folder), LINE_KEYS, "breakActive", denominator="group")


@query(f"WITH {TELE_EVENTS} SELECT {', '.join(TRACE_COLUMNS)} FROM tele_events WHERE id = {TRACED}")
def vehicle_trace(spark, folder):
    return rollups.vehicle_trace(tele_events(spark, folder), TRACED)


@query(
    f"WITH {TELE_EVENTS} SELECT {', '.join(TRACE_COLUMNS)} FROM tele_events ORDER BY timestamp, id LIMIT 200"
)
def first_k_rows(spark, folder):
    return rollups.first_rows(tele_events(spark, folder).select(*TRACE_COLUMNS), 200)


# --- wear ---------------------------------------------------------------------

_WEAR = f"""wear AS (
  SELECT id, year, month, {_each("(max({m}) - min({m})) / count(*) AS {m}Decrease", HEALTH_METRICS)}
  FROM tele_line GROUP BY id, year, month)"""


@query(f"WITH {TELE_LINE}, {_WEAR} SELECT * FROM wear")
def wear_per_vehicle(spark, folder):
    return wear.wear_rate(tele_line(spark, folder), LINE_KEYS)


@query(
    f"""WITH {TELE_LINE}, {_WEAR}
SELECT year, month, {_each('round(avg({m}), 4) AS {m}', DECREASES)} FROM wear GROUP BY year, month"""
)
def wear_per_period(spark, folder):
    means = wear.period_mean(wear.wear_rate(tele_line(spark, folder), LINE_KEYS), ("year", "month"))
    return means.withColumns({m: F.round(m, 4) for m in DECREASES})


@query(f"WITH {TELE_LINE}, {_WEAR} SELECT * FROM wear")
def wear_null_keys_split(spark, folder):
    return wear.wear_rate(tele_line(spark, folder), LINE_KEYS, null_key_mode="split")


@query(
    f"""WITH {TELE_LINE},
highs AS (SELECT id, year, month, {_each("max({m}) AS hi_{m}", HEALTH_METRICS)} FROM tele_line GROUP BY id, year, month),
lows AS (SELECT id, year, month, {_each("min({m}) AS lo_{m}", HEALTH_METRICS)} FROM tele_line GROUP BY id, year, month),
counts AS (SELECT id, year, month, count(*) AS n FROM tele_line GROUP BY id, year, month)
SELECT id, year, month, {_each("(hi_{m} - lo_{m}) / n AS {m}Decrease", HEALTH_METRICS)}
FROM highs FULL JOIN lows USING (id, year, month) FULL JOIN counts USING (id, year, month)"""
)
def wear_join_form(spark, folder):
    return wear.wear_rate_joined(tele_line(spark, folder), LINE_KEYS)


_HOLES = "SELECT * REPLACE (CASE WHEN id % 4 <> 0 THEN id END AS id, CASE WHEN month % 3 <> 0 THEN month END AS month) FROM tele_line"


@query(
    f"""WITH {TELE_LINE}, holes AS ({_HOLES}),
highs AS (SELECT id, year, month, {_each("max({m}) AS hi_{m}", HEALTH_METRICS)} FROM holes GROUP BY id, year, month),
lows AS (SELECT id, year, month, {_each("min({m}) AS lo_{m}", HEALTH_METRICS)} FROM holes GROUP BY id, year, month),
counts AS (SELECT id, year, month, count(*) AS n FROM holes GROUP BY id, year, month)
SELECT id, year, month, {_each("(hi_{m} - lo_{m}) / n AS {m}Decrease", HEALTH_METRICS)}
FROM highs FULL JOIN lows USING (id, year, month) FULL JOIN counts USING (id, year, month)"""
)
def wear_missing_keys_split(spark, folder):
    """Missing ids and months, shown as a join of separate aggregates shows them."""
    holes = tele_line(spark, folder).withColumns(
        {"id": F.when(F.col("id") % 4 != 0, F.col("id")), "month": F.when(F.col("month") % 3 != 0, F.col("month"))}
    )
    return wear.wear_rate(holes, LINE_KEYS, null_key_mode="split")


@query(
    f"""WITH {TELE_LINE},
highs AS (SELECT id, year, month, {_each("max({m}) AS hi_{m}", HEALTH_METRICS)} FROM tele_line
  WHERE id % 3 <> 0 GROUP BY id, year, month),
lows AS (SELECT id, year, month, {_each("min({m}) AS lo_{m}", HEALTH_METRICS)} FROM tele_line
  WHERE month % 2 = 0 GROUP BY id, year, month)
SELECT id, year, month, {_each("(coalesce(hi_{m}, 0) - coalesce(lo_{m}, 0)) / g.n AS {m}Decrease", HEALTH_METRICS)}
FROM highs FULL JOIN lows USING (id, year, month), (SELECT count(*) AS n FROM highs) g"""
)
def wear_one_sided(spark, folder):
    """Extremes of tables that cover different keys."""
    rows = tele_line(spark, folder)
    return wear.wear_from_extremes(
        rollups.rollup(rows.filter("id % 3 <> 0"), LINE_KEYS, HEALTH_METRICS, "max"),
        rollups.rollup(rows.filter("month % 2 = 0"), LINE_KEYS, HEALTH_METRICS, "min"),
        LINE_KEYS,
    )


_WEAR_GROUPS = f"""wear AS (
  SELECT id, year, month, {_each("(max({m}) - min({m})) / g.n AS {m}Decrease", HEALTH_METRICS)}
  FROM tele_line, (SELECT count(*) AS n FROM (SELECT DISTINCT id, year, month FROM tele_line)) g
  GROUP BY id, year, month, g.n)"""


@query(f"WITH {TELE_LINE}, {_WEAR_GROUPS} SELECT * FROM wear")
def wear_group_denominator(spark, folder):
    return wear.wear_rate(tele_line(spark, folder), LINE_KEYS, denominator="groups")


@query(f"WITH {TELE_LINE}, {_WEAR_GROUPS} SELECT * FROM wear")
def wear_aligned_subtract(spark, folder):
    rows = tele_line(spark, folder)
    return wear.wear_from_extremes(
        rollups.rollup(rows, LINE_KEYS, HEALTH_METRICS, "max"),
        rollups.rollup(rows, LINE_KEYS, HEALTH_METRICS, "min"),
        LINE_KEYS,
    )


@query(
    f"""WITH {TELE_LINE}, {_WEAR_GROUPS}
SELECT year, month, {_each('round(avg({m}), 6) AS {m}', DECREASES)} FROM wear GROUP BY year, month"""
)
def wear_group_denominator_per_period(spark, folder):
    rate = wear.wear_rate(tele_line(spark, folder), LINE_KEYS, denominator="groups", null_key_mode="drop")
    return wear.period_mean(rate, ("year", "month")).withColumns({m: F.round(m, 6) for m in DECREASES})


# --- fleets -------------------------------------------------------------------

_UNION = f"""fleet AS (
  SELECT model, consumptionKm, co2Km FROM eu
  UNION ALL SELECT model, consumptionMile / {KM_PER_MILE}, co2Mile / {KM_PER_MILE} FROM usa)"""


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 4) for n in names})


_EMISSION_SQL = f"""WITH {FLEETS}, {_UNION}
SELECT model, round(avg(consumptionKm), 4) AS consumptionKm, round(avg(co2Km), 4) AS co2Km
FROM fleet GROUP BY model"""


@query(_EMISSION_SQL)
def emission_by_model(spark, folder):
    means = emissions.emission_by_model(eu_fleet(spark, folder), usa_fleet(spark, folder))
    return _rounded(means, emissions.EMISSION_METRICS)


@query(
    f"""WITH {FLEETS}, {_UNION},
c AS (SELECT model, avg(consumptionKm) AS consumptionKm FROM fleet GROUP BY model),
e AS (SELECT model, avg(co2Km) AS co2Km FROM fleet GROUP BY model)
SELECT model, round(consumptionKm, 4) AS consumptionKm, round(co2Km, 4) AS co2Km FROM c FULL JOIN e USING (model)"""
)
def emission_join_form(spark, folder):
    means = emissions.emission_by_model_joined(eu_fleet(spark, folder), usa_fleet(spark, folder))
    return _rounded(means, emissions.EMISSION_METRICS)


@query(
    f"WITH {FLEETS} SELECT model, round(consumptionMile / {KM_PER_MILE}, 4) AS consumptionKm, "
    f"round(co2Mile / {KM_PER_MILE}, 4) AS co2Km FROM usa"
)
def unit_conversion(spark, folder):
    per_mile = usa_fleet(spark, folder).select("model", "consumptionMile", "co2Mile")
    return _rounded(convert_units(per_mile, emissions.PER_MILE, KM_PER_MILE), emissions.EMISSION_METRICS)


@query(f"WITH {FLEETS}, {_UNION} SELECT model, round(consumptionKm, 4) AS consumptionKm, round(co2Km, 4) AS co2Km FROM fleet")
def union_positional(spark, folder):
    per_mile = usa_fleet(spark, folder).select("model", "consumptionMile", "co2Mile")
    same = {"consumptionMile": "consumptionMile", "co2Mile": "co2Mile"}
    converted = convert_units(per_mile, same, KM_PER_MILE)
    renamed = rename_positional(converted, ["model", "consumptionKm", "co2Km"])
    return _rounded(relational.union_positional(eu_fleet(spark, folder), renamed), emissions.EMISSION_METRICS)


@query(
    f"""WITH {FLEETS}
SELECT model, consumptionKm, co2Km, NULL::DOUBLE AS consumptionMile, NULL::DOUBLE AS co2Mile, NULL::DOUBLE AS mph FROM eu
UNION ALL SELECT model, NULL, NULL, consumptionMile, co2Mile, mph FROM usa"""
)
def union_by_name(spark, folder):
    return relational.union_named(eu_fleet(spark, folder), usa_fleet(spark, folder))


@query(f"WITH {FLEETS} SELECT model, avg(consumptionMile) AS consumptionMile, max(mph) AS mph FROM usa GROUP BY model")
def model_avg_max(spark, folder):
    stats = emissions.model_statistics(usa_fleet(spark, folder))
    return relational.full_outer_on(["model"], stats["avg"], stats["max"])


@query(
    """SELECT o_custkey AS id, o_orderstatus AS status,
  CASE WHEN h.t IS NULL AND l.t IS NULL THEN NULL ELSE coalesce(h.t, 0) - coalesce(l.t, 0) END AS total
FROM (SELECT o_custkey, o_orderstatus, max(round(o_totalprice * 100)) AS t FROM orders
      WHERE o_orderpriority < '3' GROUP BY ALL) h
FULL JOIN (SELECT o_custkey, o_orderstatus, min(round(o_totalprice * 100)) AS t FROM orders
      WHERE o_orderpriority >= '3' GROUP BY ALL) l USING (o_custkey, o_orderstatus)"""
)
def aligned_subtract(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).alias("total"),
        (F.col("o_orderpriority") < "3").alias("urgent"),
    )
    keys = ("id", "status")
    return relational.aligned_subtract(
        rollups.rollup(orders.filter("urgent"), keys, ["total"], "max"),
        rollups.rollup(orders.filter("not urgent"), keys, ["total"], "min"),
        keys,
        ["total"],
    )


_PERIOD = ", ".join(CALENDAR)


@query(f"WITH {TELE_EVENTS} SELECT {_PERIOD}, avg(kmh) AS kmh FROM tele_events WHERE year = 2024 AND month = 1 AND day BETWEEN 5 AND 11 GROUP BY {_PERIOD}")
def date_range(spark, folder):
    week = calendar.date_range(tele_events(spark, folder), dt.date(2024, 1, 5), dt.date(2024, 1, 11))
    return rollups.rollup(week, CALENDAR, ["kmh"], "avg")
