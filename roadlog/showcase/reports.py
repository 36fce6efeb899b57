"""The end-user analyses, each output as a query."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlog.plans import daily_summary, fleet_reports, wear_report
from roadlog.plans.common import write_outputs
from roadlog.schemas import CALENDAR, HEALTH_METRICS, TRACE_COLUMNS, VEHICLE_DAY
from roadlog.showcase.analysis import TRACED
from roadlog.showcase.registry import query
from roadlog.showcase.views import (
    EVENT_METRICS,
    FLEETS,
    LINE_KEYS,
    TELE_EVENTS,
    TELE_LINE,
    eu_fleet,
    tele_events,
    tele_line,
    usa_fleet,
)
from roadlog.workspace import new_folder

_KEYS = ", ".join(VEHICLE_DAY)
_DAY = ", ".join(CALENDAR)


def _summary(spark, folder):
    return daily_summary.daily_summary(tele_events(spark, folder), TRACED, VEHICLE_DAY, EVENT_METRICS)


def _stored(spark, outputs, name):
    """The output as it comes back from its written table."""
    path = new_folder(spark, "report")
    write_outputs({name: outputs[name]}, f"{path}/tables", f"{path}/bulk")
    return spark.read.parquet(f"{path}/tables/{name}")


def _documents(spark, outputs, name):
    """``(_id, source)`` of the output's bulk file, its lines paired again."""
    path = new_folder(spark, "report")
    write_outputs({name: outputs[name]}, bulk=f"{path}/bulk")
    pairs = spark.read.text(f"{path}/bulk/{name}", lineSep='{"index"').filter("value != ''")
    lines = F.split("value", "\n")
    return pairs.select(
        F.get_json_object(F.concat(F.lit('{"index"'), lines[0]), "$.index._id").alias("_id"), lines[1].alias("source")
    )


def _field(name: str, dtype: str):
    return F.get_json_object("source", f"$.{name}").cast(dtype).alias(name)


def _grouped(fn: str) -> str:
    metrics = ", ".join(f"{fn}({m}) AS {m}" for m in EVENT_METRICS)
    return f"WITH {TELE_EVENTS} SELECT {_KEYS}, {metrics} FROM tele_events GROUP BY {_KEYS}"


@query(_grouped("avg"))
def report_daily_avg(spark, folder):
    return _stored(spark, _summary(spark, folder), "car-avg")


@query(_grouped("max"))
def report_daily_max(spark, folder):
    return _stored(spark, _summary(spark, folder), "car-max")


@query(f"WITH {TELE_EVENTS} SELECT {', '.join(TRACE_COLUMNS)} FROM tele_events WHERE id = {TRACED}")
def report_trace(spark, folder):
    return _stored(spark, _summary(spark, folder), "car-pos")


@query(
    f"""WITH {TELE_EVENTS} SELECT {_KEYS}, count(*) AS count,
  count(*) / (SELECT count(*) FROM tele_events) AS breakingPercentage
FROM tele_events WHERE breakActive GROUP BY {_KEYS}"""
)
def report_braking(spark, folder):
    return _stored(spark, _summary(spark, folder), "car-breaking")


@query(
    f"""WITH {TELE_EVENTS} SELECT {_KEYS}, avg(kmh) AS kmh, avg(rpm) AS rpm, avg(timestamp) AS timestamp,
  round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, avg(CAST(breakActive AS INTEGER)) AS breakActive
FROM tele_events GROUP BY {_KEYS}"""
)
def report_all_columns(spark, folder):
    outputs = daily_summary.daily_summary_all_columns(tele_events(spark, folder), TRACED)
    return outputs["car-avg"].rows.withColumns({c: F.round(c, 6) for c in ("lat", "lon")})


_EVENT_ID = "id || '|' || year || '|' || month || '|' || day AS _id"


@query(
    f"""WITH {TELE_EVENTS} SELECT {_EVENT_ID}, avg(kmh) AS kmh, round(avg(lat), 6) AS lat FROM tele_events
GROUP BY {_KEYS}"""
)
def report_all_columns_bulk(spark, folder):
    """The means as they stand in the bulk file."""
    outputs = daily_summary.daily_summary_all_columns(tele_events(spark, folder), TRACED)
    docs = _documents(spark, outputs, "car-avg").select("_id", _field("kmh", "double"), _field("lat", "double"))
    return docs.withColumn("lat", F.round("lat", 6))


@query(
    f"""WITH {TELE_EVENTS} SELECT {_EVENT_ID}, max(model) AS model, max(kmh) AS kmh, max(timestamp) AS timestamp
FROM tele_events GROUP BY {_KEYS}"""
)
def report_all_columns_max_bulk(spark, folder):
    outputs = daily_summary.daily_summary_all_columns(tele_events(spark, folder), TRACED)
    docs = _documents(spark, outputs, "car-max")
    return docs.select("_id", _field("model", "string"), _field("kmh", "double"), _field("timestamp", "long"))


@query(f"WITH {TELE_EVENTS} SELECT id || '|' || timestamp AS _id, lat FROM tele_events WHERE id = {TRACED}")
def report_trace_bulk(spark, folder):
    outputs = daily_summary.daily_summary_all_columns(tele_events(spark, folder), TRACED)
    return _documents(spark, outputs, "car-pos").select("_id", _field("lat", "double"))

def _health(fmt: str) -> str:
    return ", ".join(fmt.format(m=m) for m in HEALTH_METRICS)


@query(f"WITH {TELE_LINE} SELECT {_KEYS}, {_health('max({m}) AS {m}')} FROM tele_line GROUP BY {_KEYS}")
def report_wear_car(spark, folder):
    return wear_report.wear_report(tele_line(spark, folder))["wearing-parts-car"].rows


@query(f"WITH {TELE_LINE} SELECT {_KEYS}, {_health('min({m}) AS {m}')} FROM tele_line GROUP BY {_KEYS}")
def report_wear_car_documents(spark, folder):
    return wear_report.wear_report(tele_line(spark, folder))["wearing-parts-car"].documents


_MONTHLY = ", ".join(f"(max({m}) - min({m})) / count(*) AS {m}" for m in HEALTH_METRICS)


@query(
    f"""WITH {TELE_LINE}, wear AS (SELECT id, year, month, {_MONTHLY} FROM tele_line GROUP BY id, year, month)
SELECT year, month, {_health("round(avg({m}), 4) AS {m}Decrease")} FROM wear GROUP BY year, month"""
)
def report_wear_decrease(spark, folder):
    report = wear_report.wear_report(tele_line(spark, folder), LINE_KEYS, period=("year", "month"))
    out = _stored(spark, report, "wearing-parts-decrease")
    return out.withColumns({f"{m}Decrease": F.round(f"{m}Decrease", 4) for m in HEALTH_METRICS})


_OVER_GROUPS = ", ".join(f"(max({m}) - min({m})) / g.n AS {m}" for m in HEALTH_METRICS)


@query(
    f"""WITH {TELE_LINE},
groups AS (SELECT count(*) AS n FROM (SELECT DISTINCT {_KEYS} FROM tele_line)),
wear AS (SELECT {_KEYS}, {_OVER_GROUPS} FROM tele_line, groups g GROUP BY {_KEYS}, g.n)
SELECT {_DAY}, {_health("round(avg({m}), 6) AS {m}")} FROM wear GROUP BY {_DAY}"""
)
def report_wear_over_groups(spark, folder):
    out = wear_report.wear_report_over_groups(tele_line(spark, folder))["wearing-parts-decrease"].rows
    return out.withColumns({m: F.round(m, 6) for m in HEALTH_METRICS})


@query(
    f"""WITH {FLEETS}, fleet AS (SELECT * FROM eu
  UNION ALL SELECT model, consumptionMile / 1.6, co2Mile / 1.6 FROM usa)
SELECT model, round(avg(consumptionKm), 4) AS consumptionKm, round(avg(co2Km), 4) AS co2Km FROM fleet GROUP BY model"""
)
def report_emission(spark, folder):
    outputs = fleet_reports.emission_report(eu_fleet(spark, folder), usa_fleet(spark, folder))
    rows = _stored(spark, outputs, "consumption-emission")
    return rows.withColumns({c: F.round(c, 4) for c in ("consumptionKm", "co2Km")})


@query(f"WITH {FLEETS} SELECT model, avg(consumptionMile) AS consumptionMile FROM usa GROUP BY model")
def report_model_avg(spark, folder):
    outputs = fleet_reports.model_report(usa_fleet(spark, folder))
    docs = _documents(spark, outputs, "mile-avg-usa")
    return docs.select(F.col("_id").alias("model"), _field("consumptionMile", "double"))


@query(f"WITH {FLEETS} SELECT model, max(mph) AS mph FROM usa GROUP BY model")
def report_model_max(spark, folder):
    outputs = fleet_reports.model_report(usa_fleet(spark, folder))
    docs = _documents(spark, outputs, "mph-max-usa")
    return docs.select(F.col("_id").alias("model"), _field("mph", "double"))
