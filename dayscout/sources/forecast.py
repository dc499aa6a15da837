"""Forecast payloads: JSON of parallel daily arrays to one typed row per place and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayscout.functions.scoring import midrange
from dayscout.functions.text import safe_float, safe_int, safe_int_number

# Payload variable and the column it becomes.
DAILY_VARIABLES = [
    ("temperature_2m_max", "temp_max"),
    ("temperature_2m_min", "temp_min"),
    ("precipitation_sum", "precipitation"),
    ("wind_speed_10m_max", "wind_speed_max"),
    ("wind_gusts_10m_max", "wind_gusts_max"),
]
WEATHER_CODE = "weather_code"

_DAILY = ", ".join(
    ["time: ARRAY<STRING>"]
    + [f"{name}: ARRAY<STRING>" for name, _ in DAILY_VARIABLES]
    + [f"{WEATHER_CODE}: ARRAY<VARIANT>"]
)
PAYLOAD_SCHEMA = f"daily STRUCT<{_DAILY}>, _corrupt STRING"


def _code(element: Column) -> Column:
    """A JSON number is truncated; JSON text must be an integer literal."""
    is_text = F.schema_of_variant(element) == "STRING"
    number = F.try_variant_get(element, "$", "double")
    text = F.try_variant_get(element, "$", "string")
    return F.when(is_text, safe_int(text)).otherwise(safe_int_number(number))


def parse_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds the parsed ``daily`` struct and ``_corrupt``, the text that is not JSON."""
    parsed = F.from_json(
        payload, PAYLOAD_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    )
    return payloads.withColumn("_parsed", parsed).select(
        *payloads.columns, F.col("_parsed.daily").alias("daily"), F.col("_parsed._corrupt")
    )


def parse_forecasts(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per (city, day). An empty or missing ``time`` gives no rows; a missing
    variable gives NULLs; payloads that do not parse give no rows (count them with
    ``corrupt_payloads``). Columns other than the payload are kept."""
    kept = [c for c in payloads.columns if c != payload]
    daily = parse_payloads(payloads, payload).select(
        *kept, "daily", F.posexplode("daily.time").alias("_i", "_day")
    )
    i = F.col("_i")
    typed = daily.select(
        *kept,
        F.col("_day").try_cast("date").alias("date"),
        *[safe_float(F.get(F.col(f"daily.{src}"), i)).alias(dst) for src, dst in DAILY_VARIABLES],
        _code(F.get(F.col(f"daily.{WEATHER_CODE}"), i)).alias(WEATHER_CODE),
    )
    return typed.where(F.col("date").isNotNull()).select(
        *kept,
        "date",
        "temp_max",
        "temp_min",
        midrange(F.col("temp_max"), F.col("temp_min")).alias("temp_mean"),
        "precipitation",
        "wind_speed_max",
        "wind_gusts_max",
        WEATHER_CODE,
    )


def corrupt_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    return parse_payloads(payloads, payload).agg(
        F.count("*").alias("payloads"), F.count("_corrupt").alias("corrupt")
    )
