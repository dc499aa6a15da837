"""Aggregations. All are partial-then-final, so hot keys shrink before any exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayscout.functions.scoring import absolute_error
from dayscout.functions.text import cluster_line
from dayscout.operators.ranking import by_score, top_n
from dayscout.sources.scans import When, day


def distinct_places(obs: DataFrame, expected: int = 20) -> DataFrame:
    n = F.countDistinct("city")
    return obs.agg(n.alias("city_count"), (n < expected).alias("below_expected"))


def missing_recent(obs: DataFrame, as_of: When) -> DataFrame:
    recent = obs.where(F.col("date") >= day(as_of))
    return recent.agg(F.count_if(F.col("temp_mean").isNull()).alias("null_count"))


def count_recent(obs: DataFrame, as_of: When) -> DataFrame:
    return obs.where(F.col("date") >= day(as_of)).agg(F.count("*").alias("n_recent"))


def is_outlier() -> Column:
    t, p = F.col("temp_mean"), F.col("precipitation")
    return (t < -20) | (t > 50) | (p > 200)


def outliers(obs: DataFrame, as_of: When) -> DataFrame:
    return obs.where((F.col("date") >= day(as_of)) & is_outlier()).select(
        "city", "date", "temp_mean", "precipitation"
    )


def score_distribution(scores: DataFrame, by: Sequence[str] = ("profile_name",)) -> DataFrame:
    return scores.groupBy(*by).agg(
        F.avg("comfort_score").alias("avg_score"),
        F.max("comfort_score").alias("max_score"),
        F.min("comfort_score").alias("min_score"),
    )


def feature_stats(features: DataFrame) -> DataFrame:
    return features.agg(
        F.avg("temp_mean_7d").alias("avg_temp_7d"),
        F.avg("precip_sum_7d").alias("avg_precip_7d"),
        F.avg("wind_max_7d").alias("avg_wind_7d"),
        F.avg("comfort_score").alias("avg_comfort"),
        F.stddev_samp("comfort_score").alias("std_comfort"),
        F.count("*").alias("n_rows"),
    )


def coverage(pois: DataFrame, columns: Sequence[str] = ("stars", "website_url", "amenities")):
    """Filled counts and percentages (one decimal; NULL when there are no rows)."""
    total = F.count("*")
    out = [total.alias("total")]
    for c in columns:
        out += [
            F.count(c).alias(f"with_{c}"),
            F.round(100.0 * F.count(c) / F.nullif(total, F.lit(0)), 1).alias(f"{c}_percentage"),
        ]
    return pois.agg(*out)


def place_averages(features: DataFrame) -> DataFrame:
    """Means of decimals: a sum of doubles ends in digits that depend on the order of its
    rows, and equal means would not tie."""
    score = F.col("comfort_score").try_cast("decimal(28, 10)")
    return features.groupBy("city").agg(F.avg(score).cast("double").alias("avg_score"))


def place_extremes(features: DataFrame, n: int = 3) -> DataFrame:
    """The n best and n worst places by mean score."""
    means = place_averages(features)
    best = top_n(means, by_score("avg_score"), n).withColumn("side", F.lit("best"))
    worst = top_n(means, [F.col("avg_score").asc_nulls_last(), F.col("city")], n)
    return best.unionByName(worst.withColumn("side", F.lit("worst")))


def cluster_stats(
    rows: DataFrame, group: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Size and mean weather per cluster. Empty clusters give no row."""
    means = [
        ("avg_temp", "temp_mean_7d"),
        ("avg_precip", "precip_sum_7d"),
        ("avg_wind", "wind_max_7d"),
    ]
    out = []
    for name, source in means:
        mean = F.avg(source)
        out.append((mean if digits is None else F.round(mean, digits)).alias(name))
    return rows.groupBy(*group, "cluster_id").agg(F.count("*").alias("size"), *out)


def cluster_members(rows: DataFrame, key: Sequence[str] = ("city",)) -> DataFrame:
    """The places of each cluster, as rows: a cluster may hold any share of them."""
    return rows.select("cluster_id", *key)


def cluster_breakdown(stats: DataFrame) -> DataFrame:
    """One text with a line per cluster, ordered by cluster id (k lines)."""
    line = F.struct(
        "cluster_id",
        cluster_line(
            F.col("cluster_id"), F.col("size"), F.col("avg_temp"), F.col("avg_precip"),
            F.col("avg_wind"),
        ).alias("line"),
    )
    lines = F.array_sort(F.collect_list(line))
    return stats.agg(F.concat_ws("\n", F.transform(lines, lambda x: x["line"])).alias("breakdown"))


def distribution(value: str) -> list[Column]:
    """Count, mean, population deviation, extremes of one column."""
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def target_stats(features: DataFrame, target: str = "comfort_score") -> DataFrame:
    return features.agg(*distribution(target))


def regression_metrics(
    rows: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    group: Sequence[str] = (),
    digits: tuple[int, int, int] | None = (2, 2, 3),
) -> DataFrame:
    """RMSE, MAE and R2 from one pass. The total sum of squares is n * var_pop(actual). Equal
    values have no R2; their variance in doubles may be a little above 0."""
    y, e = F.col(actual), F.col(predicted) - F.col(actual)
    sse = F.sum(e * e)
    n = F.count("*")
    sst = F.var_pop(y) * n
    metrics = [
        ("rmse", F.sqrt(sse / n)),
        ("mae", F.avg(absolute_error(F.col(predicted), y))),
        ("r2", F.when((sst > 0) & (F.min(y) < F.max(y)), 1 - sse / sst)),
    ]
    places = digits or (None, None, None)
    out = [
        (m if d is None else F.round(m, d)).alias(name)
        for (name, m), d in zip(metrics, places, strict=True)
    ]
    return rows.groupBy(*group).agg(*out, n.alias("n_samples"))


def pois_per_place(places: DataFrame, pois: DataFrame, expected: int = 5) -> DataFrame:
    """Points of interest per place including zero, flagged below ``expected``."""
    counts = pois.groupBy("city").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return places.select("city").join(counts, "city", "left").select(
        "city", n.alias("n_pois"), (n < expected).alias("too_few")
    )


def recommendation_dates(recs: DataFrame, profile: str, n: int = 30) -> DataFrame:
    dates = recs.where(F.col("profile_name") == profile).select("recommendation_date").distinct()
    return top_n(dates, [F.col("recommendation_date").desc()], n)


def best_place(features: DataFrame) -> DataFrame:
    """Highest-scoring place (ties by name) with the mean and maximum score."""
    # min_by on (-score, city) is the maximum score with the first name on ties.
    first = F.min_by("city", F.struct(-F.col("comfort_score"), F.col("city")))
    return features.agg(
        first.alias("city"),
        F.avg("comfort_score").alias("avg_score"),
        F.max("comfort_score").alias("max_score"),
    )


def extent(features: DataFrame) -> DataFrame:
    return features.agg(
        F.min("feature_date").alias("first_date"),
        F.max("feature_date").alias("last_date"),
        F.count("*").alias("n_rows"),
        F.countDistinct("city").alias("n_places"),
    )


def drift_alerts(log: DataFrame) -> DataFrame:
    return (
        log.where("drift_detected").groupBy("metric_name").agg(F.count("*").alias("drift_count"))
    )


def recommendations_per_profile(recs: DataFrame) -> DataFrame:
    return recs.groupBy("profile_name").agg(
        F.count("*").alias("n_recommendations"),
        F.avg("comfort_score_pred").alias("avg_score"),
    )
