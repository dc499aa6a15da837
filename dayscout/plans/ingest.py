"""Ingest of daily observations with its quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayscout.operators.aggregates import is_outlier
from dayscout.operators.writes import upsert_replace
from dayscout.schemas import OBSERVATIONS
from dayscout.sources.forecast import parse_forecasts
from dayscout.sources.scans import When, day


def ingest(old: DataFrame, payloads: DataFrame, order: list[Column]) -> DataFrame:
    """Parse the payloads and upsert them; of several values for a key the first by
    ``order`` wins, which may use any column of the payloads (such as the receive time)."""
    return upsert_replace(old, parse_forecasts(payloads), OBSERVATIONS.key, order)


def quality_report(obs: DataFrame, as_of: When, expected_places: int = 20) -> DataFrame:
    """All quality figures in one pass over the table."""
    recent = F.col("date") >= day(as_of)
    n_places = F.countDistinct("city")
    return obs.agg(
        n_places.alias("city_count"),
        (n_places < expected_places).alias("below_expected"),
        F.count_if(recent & F.col("temp_mean").isNull()).alias("null_count"),
        F.count_if(recent & is_outlier()).alias("outlier_count"),
        F.count_if(recent).alias("n_recent"),
    )
