"""Field lists and explicit schemas of the telemetry tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the vehicle messages.
DAILY_METRICS = (
    "kmh",
    "rpm",
    "oilLevel",
    "breakFluidLevel",
    "fuelLevel",
    "temperatureEngine",
    "temperatureInside",
    "temperatureOutside",
    "temperatureBreaks",
    "temperatureTires",
    "gasPower",
    "breakPower",
    "consumptionKm",
)
HEALTH_METRICS = (
    "breaksHealth",
    "mufflerHealth",
    "engineHealth",
    "tireHealth",
    "gearsHealth",
    "batteryHealth",
)
CALENDAR = ("year", "month", "day")
VEHICLE_DAY = ("id", *CALENDAR)
TRACE_COLUMNS = ("id", "timestamp", "lat", "lon", *CALENDAR)

# kilometres per mile used by the unit conversion
KM_PER_MILE = 1.6


def _doubles(names) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


_identity = [T.StructField("id", T.StringType()), T.StructField("model", T.StringType())]

EU_VALUE = T.StructType(
    _identity
    + _doubles(("lat", "lon", *DAILY_METRICS, "co2Km"))
    + [T.StructField("breakActive", T.BooleanType())]
    + _doubles(HEALTH_METRICS)
)

USA_VALUE = T.StructType(
    _identity
    + _doubles(("lat", "lon", "mph", *(m for m in DAILY_METRICS if m not in ("kmh", "consumptionKm"))))
    + _doubles(("consumptionMile", "co2Mile"))
    + [T.StructField("breakActive", T.BooleanType())]
    + _doubles(HEALTH_METRICS)
)


def with_time_columns(value: T.StructType) -> T.StructType:
    """Schema of a stored row: the value fields, then timestamp and calendar."""
    taken = {"timestamp", *CALENDAR}
    return T.StructType(
        [f for f in value.fields if f.name not in taken]
        + [T.StructField("timestamp", T.LongType())]
        + [T.StructField(c, T.IntegerType()) for c in CALENDAR]
    )


EU_TABLE = with_time_columns(EU_VALUE)
USA_TABLE = with_time_columns(USA_VALUE)
