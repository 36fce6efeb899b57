"""The benchmark tables seen as vehicle telemetry, in Spark and in SQL.

Amounts are brought to whole numbers (cents, percent) so that sums are exact in
any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlog.schemas import HEALTH_METRICS

# lineitem is grouped by supplier and month
LINE_KEYS = ("id", "year", "month")
EVENT_METRICS = ("kmh", "rpm")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(c: Column) -> Column:
    """Nearest whole number, as a double."""
    return F.floor(c + 0.5).cast("double")


def _whole(c: str) -> str:
    return f"floor({c} + 0.5)"


def _calendar(c: str) -> dict:
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


_SQL_CALENDAR = (
    "CAST(year({c}) AS INTEGER) AS year, CAST(month({c}) AS INTEGER) AS month, CAST(day({c}) AS INTEGER) AS day"
)


def tele_line(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per order line: six falling values and a flag."""
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    health = (
        F.col("l_quantity"),
        whole(price),
        whole(discount * 100),
        whole(tax * 100),
        whole(price * (1 - discount)),
        whole(price * (1 + tax)),
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        *[c.alias(n) for n, c in _calendar("l_shipdate").items()],
        *[c.alias(n) for n, c in zip(HEALTH_METRICS, health)],
        (F.col("l_returnflag") == "R").alias("breakActive"),
    )


TELE_LINE = f"""tele_line AS (
  SELECT l_suppkey AS id, {_SQL_CALENDAR.format(c='l_shipdate')},
    l_quantity AS breaksHealth, {_whole('l_extendedprice')} AS mufflerHealth,
    {_whole('l_discount * 100')} AS engineHealth, {_whole('l_tax * 100')} AS tireHealth,
    {_whole('l_extendedprice * (1 - l_discount)')} AS gearsHealth,
    {_whole('l_extendedprice * (1 + l_tax)')} AS batteryHealth,
    l_returnflag = 'R' AS breakActive
  FROM lineitem)"""


def tele_events(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per event: vehicle = user, model = event type."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        *[c.alias(n) for n, c in _calendar("ts").items()],
        F.col("event_type").alias("model"),
        whole(F.col("value") * 100).alias("kmh"),
        F.get_json_object("props", "$.k").cast("double").alias("rpm"),
        (F.col("value") / 10).alias("lat"),
        F.col("value").alias("lon"),
        (F.col("event_type") == "error").alias("breakActive"),
    )


TELE_EVENTS = f"""tele_events AS (
  SELECT user_id AS id, epoch_us(ts) // 1000 AS timestamp, {_SQL_CALENDAR.format(c='ts')},
    event_type AS model, {_whole('value * 100')} AS kmh,
    CAST(json_extract(props, '$.k') AS DOUBLE) AS rpm,
    value / 10 AS lat, value AS lon, event_type = 'error' AS breakActive
  FROM events)"""


def _fleet(spark: SparkSession, folder: str, status: str) -> DataFrame:
    return table(spark, folder, "lineitem").filter(F.col("l_linestatus") == status).withColumns(
        {
            "model": F.concat(F.lit("m"), F.col("l_partkey")),
            "cents": whole(F.col("l_extendedprice") * 100),
        }
    )


def eu_fleet(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines of one status: per-kilometre columns."""
    return _fleet(spark, folder, "F").select(
        "model", F.col("l_quantity").alias("consumptionKm"), F.col("cents").alias("co2Km")
    )


def usa_fleet(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines of the other status: per-mile columns."""
    return _fleet(spark, folder, "O").select(
        "model",
        F.col("l_quantity").alias("consumptionMile"),
        F.col("cents").alias("co2Mile"),
        whole(F.col("l_tax") * 100).alias("mph"),
    )


FLEETS = f"""eu AS (
  SELECT 'm' || l_partkey AS model, l_quantity AS consumptionKm, {_whole('l_extendedprice * 100')} AS co2Km
  FROM lineitem WHERE l_linestatus = 'F'),
usa AS (
  SELECT 'm' || l_partkey AS model, l_quantity AS consumptionMile, {_whole('l_extendedprice * 100')} AS co2Mile,
    {_whole('l_tax * 100')} AS mph
  FROM lineitem WHERE l_linestatus = 'O')"""
