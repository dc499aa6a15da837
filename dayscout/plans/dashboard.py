"""The data behind the dashboard page: one frame per widget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.operators.aggregates import recommendation_dates
from dayscout.operators.places import (
    recommendations_with_places,
    top_pois,
    with_weather_for_top,
)
from dayscout.operators.runlog import current_champion
from dayscout.plans.recommend import top3_by_profile
from dayscout.sources.scans import When, day


@dataclass(frozen=True)
class Dashboard:
    dates: DataFrame
    champions: DataFrame
    recommendations: DataFrame
    lodgings: DataFrame
    comparison: DataFrame


def dashboard(
    recs: DataFrame,
    places: DataFrame,
    scores: DataFrame,
    features: DataFrame,
    pois: DataFrame,
    runs: DataFrame,
    as_of: When,
    profile: str,
) -> Dashboard:
    on_day = recs.where(F.col("recommendation_date") == day(as_of))
    top10 = on_day.where((F.col("profile_name") == profile) & (F.col("rank") <= 10))
    shown = with_weather_for_top(recommendations_with_places(top10, places, scores), features)
    top5 = top10.where(F.col("rank") <= 5)
    return Dashboard(
        dates=recommendation_dates(recs, profile),
        champions=current_champion(runs),
        recommendations=shown.orderBy("rank"),
        lodgings=top_pois(top5, pois, 5),
        comparison=top3_by_profile(on_day),
    )
