"""Recommendation jobs: by profile score, by predicted score, and by rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayscout.functions.scoring import absolute_error, rule_score
from dayscout.operators.aggregates import cluster_stats
from dayscout.operators.profiles import join_scores, score_profiles
from dayscout.operators.ranking import keep_good_clusters, rank_clusters, rank_within
from dayscout.operators.writes import retain_since, upsert_replace
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES
from dayscout.sources.dims import Profile
from dayscout.sources.scans import When, day, features_on

RETENTION_DAYS = 7


def complete(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with none of ``columns`` missing, the key kept next to its values."""
    return features.dropna(subset=list(columns))


def by_profiles(
    features: DataFrame,
    scores: DataFrame | Sequence[Profile],
    assign,
    form: str = "gauss",
    keep: int = 2,
) -> DataFrame:
    """Cluster filter, then rank by profile score, for all profiles and dates at once.

    ``assign`` maps a frame of features to the same frame with ``cluster_id``. The
    clusters depend on features only, so they are found once, not once per profile.
    ``scores`` is the stored score table, or the profiles themselves: scoring the
    surviving rows in place is cheaper than a join when the table is not at hand.
    """
    clustered = assign(complete(features, CLUSTER_FEATURES))
    ranked = rank_clusters(cluster_stats(clustered, ["feature_date"]), form, ["feature_date"])
    good = keep_good_clusters(clustered, ranked, keep, ["feature_date"])
    if isinstance(scores, DataFrame):
        scored = join_scores(good, scores).where(F.col("profile_name").isNotNull())
        scored = scored.drop("comfort_score").withColumnRenamed(
            "comfort_score_profile", "comfort_score"
        )
    else:
        scored = score_profiles(good, scores, keep=["cluster_id"])
    rows = scored.select(
        F.col("feature_date").alias("recommendation_date"),
        "city",
        "profile_name",
        "cluster_id",
        F.col("comfort_score").alias("comfort_score_pred"),
    )
    return rank_within(rows, ["recommendation_date", "profile_name"], "comfort_score_pred")


def recommend_profiles(
    features: DataFrame, scores: DataFrame, as_of: When, assign, form: str = "gauss"
) -> DataFrame:
    return by_profiles(
        features_on(features, as_of), scores.where(F.col("feature_date") == day(as_of)), assign, form
    )


def recommend_predicted(features: DataFrame, as_of: When, assign, predict) -> DataFrame:
    """Cluster filter by the linear form, then rank by the predicted score.

    ``predict`` adds a ``predicted`` column to a frame of features.
    """
    today = complete(features_on(features, as_of), [*CLUSTER_FEATURES, *REGRESSION_FEATURES])
    clustered = assign(today)
    ranked = rank_clusters(cluster_stats(clustered), "linear")
    good = predict(keep_good_clusters(clustered, ranked))
    rows = good.select(
        F.col("feature_date").alias("recommendation_date"),
        "city",
        "cluster_id",
        F.col("predicted").alias("comfort_score_pred"),
        F.round(absolute_error(F.col("predicted"), F.col("comfort_score")), 2).alias(
            "prediction_error"
        ),
    )
    # the unrounded prediction ranks; it is rounded as it is written
    ranked_rows = rank_within(rows, ["recommendation_date"], "comfort_score_pred")
    return ranked_rows.withColumn("comfort_score_pred", F.round("comfort_score_pred", 2))


def rule_scores(features: DataFrame) -> DataFrame:
    t, p, w = (F.col(c) for c in REGRESSION_FEATURES)
    return features.select(
        F.col("feature_date").alias("recommendation_date"),
        "city",
        rule_score(t, p, w).alias("score"),
        t.alias("temperature"),
        p.alias("precipitation"),
        w.alias("wind_speed"),
    )


def recommend_rules(features: DataFrame, as_of: When, old: DataFrame | None = None) -> DataFrame:
    """Banded scores of the day's places, upserted after the retention of older rows: a
    place of the same day that is not in the batch stays."""
    today = rule_scores(features_on(features, as_of))
    if old is None:
        return today
    kept = retain_since(old, "recommendation_date", F.date_sub(day(as_of), RETENTION_DAYS))
    key = ["recommendation_date", "city"]
    return upsert_replace(kept, today, key, [F.col("score").desc_nulls_last()])


def pivot_top3(recs: DataFrame, profiles: Sequence[str]) -> DataFrame:
    """Top three places per date, one column per profile."""
    top = recs.where(F.col("rank") <= 3)
    return (
        top.groupBy("recommendation_date", "rank")
        .pivot("profile_name", list(profiles))
        .agg(F.first("city"))
    )


def top3_by_profile(recs: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    top = recs.where(F.col("rank") <= 3)
    return top.orderBy(*(order or ("profile_name", "rank")))
