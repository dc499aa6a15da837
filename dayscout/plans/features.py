"""Daily features and the historical backfill."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.operators.profiles import score_profiles, with_default_score
from dayscout.operators.timeseries import latest_per_place, rolling_carried, rolling_features
from dayscout.operators.writes import new_rows, upsert_replace
from dayscout.schemas import FEATURES, PROFILE_SCORES
from dayscout.sources.dims import SEED_PROFILES, Profile
from dayscout.sources.scans import When, observations_history, observations_lookback


@dataclass(frozen=True)
class DailyFeatures:
    features: DataFrame
    scores: DataFrame


def compute_daily(
    obs: DataFrame,
    as_of: When,
    profiles: Sequence[Profile] = tuple(SEED_PROFILES),
    lookback_days: int = 30,
    anchor: str = "as_of",
    digits: int | None = 2,
) -> DailyFeatures:
    """The newest feature row of each place, and its score under every profile.

    Profile scores use the rounded 3-day values; the leisure score then replaces the
    general one.
    """
    recent = observations_lookback(obs, as_of, lookback_days)
    newest = latest_per_place(rolling_features(recent), as_of, anchor).drop("observed_date")
    scores = score_profiles(newest, profiles, digits=digits)
    return DailyFeatures(with_default_score(newest, scores), scores)


def store_daily(daily: DailyFeatures, old_features: DataFrame, old_scores: DataFrame) -> DailyFeatures:
    """Upsert both results; a rerun for the same day replaces the earlier rows."""
    order = [F.col("feature_date")]
    return DailyFeatures(
        upsert_replace(
            old_features, daily.features.select(*old_features.columns), FEATURES.key, order
        ),
        upsert_replace(
            old_scores, daily.scores.select(*old_scores.columns), PROFILE_SCORES.key, order
        ),
    )


def backfill(obs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Features of every place on every past date.

    One window pass over the history plus the as-of carry forward gives the rows that
    recomputing the history once per date would give. With ``existing`` only the rows
    whose key is not there yet are returned (insert, ignoring conflicts).
    """
    rows = rolling_carried(observations_history(obs))
    if existing is None:
        return rows
    return new_rows(existing, rows, FEATURES.key, [F.col("observed_date").desc()])
