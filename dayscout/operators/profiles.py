"""Every feature row scored under every profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.functions.scoring import profile_score
from dayscout.schemas import REGRESSION_FEATURES
from dayscout.sources.dims import DEFAULT_PROFILE, SEED_PROFILES, Profile


PARAMETERS = [
    "temp_weight", "temp_ideal", "temp_tolerance", "rain_weight", "rain_decay",
    "rain_preference", "wind_weight", "wind_decay", "wind_preference",
]


def score_profiles(
    features: DataFrame,
    profiles: DataFrame | Sequence[Profile] = tuple(SEED_PROFILES),
    inputs: Sequence[str] = tuple(REGRESSION_FEATURES),
    digits: int | None = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(city, feature_date, profile_name, comfort_score), one row per profile, next to
    the columns in ``keep``.

    ``profiles`` is the stored profile table: its rows are gathered into one array of
    parameters and every feature row is fanned out by it, so the plan is the same for
    any number of profiles and no feature row is shuffled. Profiles given as objects are
    folded into one expression each, which saves reading the table.
    """
    temp, rain, wind = (F.col(c) for c in inputs)
    if isinstance(profiles, DataFrame):
        names = ["profile_name", *PARAMETERS]
        listed = profiles.agg(F.array_sort(F.collect_list(F.struct(*names)))).scalar()
        fanned = features.select(
            "city", "feature_date", *keep, *inputs, F.explode(listed).alias("_p")
        )
        parameters = {p: F.col(f"_p.{p}") for p in PARAMETERS}
        score = profile_score(temp, rain, wind, parameters, digits=digits)
        return fanned.select(
            "city", "feature_date", *keep, "_p.profile_name", score.alias("comfort_score")
        )
    scored = F.array(
        *[
            F.struct(
                F.lit(p.profile_name).alias("profile_name"),
                profile_score(temp, rain, wind, p, digits=digits).alias("comfort_score"),
            )
            for p in profiles
        ]
    )
    return features.select("city", "feature_date", *keep, F.inline(scored))


def with_default_score(
    features: DataFrame, scores: DataFrame, profile: str = DEFAULT_PROFILE
) -> DataFrame:
    """Replace the general score by one profile's score, 0 where there is none."""
    chosen = scores.where(F.col("profile_name") == profile).select(
        "city", "feature_date", F.col("comfort_score").alias("_chosen")
    )
    joined = features.drop("comfort_score").join(chosen, ["city", "feature_date"], "left")
    return joined.withColumn("comfort_score", F.coalesce("_chosen", F.lit(0.0))).drop("_chosen")


def join_scores(features: DataFrame, scores: DataFrame, suffix: str = "_profile") -> DataFrame:
    """Features left joined with the scores of all profiles at once; the score column
    keeps both versions."""
    renamed = scores.select(
        "city",
        "feature_date",
        "profile_name",
        F.col("comfort_score").alias(f"comfort_score{suffix}"),
    )
    return features.join(renamed, ["city", "feature_date"], "left")
