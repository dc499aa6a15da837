"""Aggregations."""

import datetime as dt

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check
from checks.expressions import HISTORY_SQL, PREDICTED_SQL, predicted
from checks.sinks import DRIFT_BY_PLACE_SQL, DRIFT_REPLAY_SQL, drift_log_by_place
from dayscout.operators import aggregates as ops
from dayscout.operators.ks import ks_two_sample, two_sample_summary
from dayscout.operators.runlog import history_stats
from dayscout.operators.writes import one_per_key
from dayscout.plans import drift

# A day well inside the data, so that "from this day on" has rows.
SINCE = dt.date(2000, 1, 1)
_SINCE = "DATE '2000-01-01'"


@check(
    "count_distinct_places",
    "SELECT count(DISTINCT city) AS city_count, count(DISTINCT city) < 20 AS below_expected FROM obs",
)
def count_distinct_places(spark, d):
    return ops.distinct_places(c.obs(spark, d))


@check(
    "count_null_recent",
    f"SELECT count(*) AS null_count FROM obs WHERE temp_mean IS NULL AND date >= {_SINCE}",
)
def count_null_recent(spark, d):
    return ops.missing_recent(c.obs(spark, d), SINCE)


@check("count_recent", f"SELECT count(*) AS n_recent FROM obs WHERE date >= {_SINCE}")
def count_recent(spark, d):
    return ops.count_recent(c.obs(spark, d), SINCE)


@check(
    "profile_distribution",
    """SELECT feature_date, profile_name, round(avg(comfort_score) + 1e-9, 6) AS avg_score,
         max(comfort_score) AS max_score, min(comfort_score) AS min_score
       FROM scores GROUP BY 1, 2""",
)
def profile_distribution(spark, d):
    """Of every day."""
    stats = ops.score_distribution(c.scores(spark, d), ["feature_date", "profile_name"])
    return stats.withColumn("avg_score", c.r6("avg_score"))


@check(
    "feature_stats_global",
    """SELECT round(avg(temp_mean_7d) + 1e-9, 6) AS avg_temp_7d, round(avg(precip_sum_7d) + 1e-9, 6) AS avg_precip_7d,
         round(avg(wind_max_7d) + 1e-9, 6) AS avg_wind_7d, round(avg(comfort_score) + 1e-9, 6) AS avg_comfort,
         round(stddev_samp(comfort_score) + 1e-9, 6) AS std_comfort, count(*) AS n_rows FROM features""",
)
def feature_stats_global(spark, d):
    stats = ops.feature_stats(c.features(spark, d))
    return stats.select(*[c.r6(x).alias(x) for x in stats.columns[:-1]], "n_rows")


@check(
    "coverage_pct",
    """SELECT count(*) AS total, count(stars) AS with_stars,
         round(100.0::DOUBLE*count(stars)/count(*), 1) AS stars_percentage,
         count(website_url) AS with_website_url,
         round(100.0::DOUBLE*count(website_url)/count(*), 1) AS website_url_percentage,
         count(amenities) AS with_amenities,
         round(100.0::DOUBLE*count(amenities)/count(*), 1) AS amenities_percentage FROM pois""",
)
def coverage_pct(spark, d):
    return ops.coverage(c.pois(spark, d))


_MEANS = "SELECT city, avg(comfort_score) AS a FROM features GROUP BY 1"


@check(
    "place_avg_extremes",
    f"""WITH m AS ({_MEANS})
        SELECT city, round(a + 1e-9, 6) AS avg_score, 'best' AS side FROM (SELECT * FROM m ORDER BY a DESC, city LIMIT 3)
        UNION ALL
        SELECT city, round(a + 1e-9, 6), 'worst' FROM (SELECT * FROM m ORDER BY a, city LIMIT 3)""",
)
def place_avg_extremes(spark, d):
    found = ops.place_extremes(c.features(spark, d))
    return found.withColumn("avg_score", c.r6("avg_score"))


@check(
    "cluster_stats",
    """SELECT feature_date, cluster_id, count(*) AS size, round(avg(temp_mean_7d) + 1e-9, 6) AS avg_temp,
         round(avg(precip_sum_7d) + 1e-9, 6) AS avg_precip, round(avg(wind_max_7d) + 1e-9, 6) AS avg_wind
       FROM clustered GROUP BY 1, 2""",
)
def cluster_stats(spark, d):
    found = ops.cluster_stats(c.clustered(spark, d), ["feature_date"])
    means = ("avg_temp", "avg_precip", "avg_wind")
    return found.select("feature_date", "cluster_id", "size", *[c.r6(x).alias(x) for x in means])


@check(
    "cluster_members",
    "SELECT cluster_id, city, feature_date FROM clustered",
)
def cluster_members(spark, d):
    return ops.cluster_members(c.clustered(spark, d), ["city", "feature_date"])


@check(
    "distribution_summary",
    f"""WITH {DRIFT_REPLAY_SQL} SELECT check_date, metric_name, is_current, count(value) AS n,
          round(avg(value) + 1e-9, 6) AS mean, round(stddev_pop(value) + 1e-9, 6) AS std, min(value) AS min,
          max(value) AS max FROM sized GROUP BY 1, 2, 3""",
)
def distribution_summary(spark, d):
    samples = drift.replayed_samples(c.features(spark, d))
    stats = samples.groupBy("check_date", "metric_name", "is_current").agg(
        *ops.distribution("value")
    )
    return stats.withColumn("mean", c.r6("mean")).withColumn("std", c.r6("std"))


@check(
    "ks_two_sample",
    f"""WITH {DRIFT_REPLAY_SQL} SELECT check_date, metric_name, round(ks_statistic + 1e-9, 6) AS ks_statistic,
          baseline_n AS baseline_samples, current_n AS current_samples FROM drifts""",
)
def ks(spark, d):
    samples = drift.replayed_samples(c.features(spark, d))
    found = ks_two_sample(samples, ["check_date", "metric_name"], "value", "is_current")
    return found.select(
        "check_date", "metric_name", c.r6("ks_statistic").alias("ks_statistic"),
        "baseline_samples", "current_samples",
    )


# The two halves of the whole history, unrounded means: many distinct values.
@check(
    "ks_unrounded",
    """WITH mid AS (SELECT DATE '1998-06-01' AS m),
       s AS (SELECT city, temp_mean_7d AS v, feature_date >= (SELECT m FROM mid) AS cur
             FROM raw_features WHERE temp_mean_7d IS NOT NULL),
       z AS (SELECT *, count(*) FILTER (WHERE NOT cur) OVER (PARTITION BY city) nb,
               count(*) FILTER (WHERE cur) OVER (PARTITION BY city) nc FROM s),
       st AS (SELECT city, nb, nc, count(*) FILTER (WHERE NOT cur) OVER v cb,
               count(*) FILTER (WHERE cur) OVER v cc FROM z
              WINDOW v AS (PARTITION BY city ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
       SELECT city, round(max(abs(cb::DOUBLE/nullif(nb, 0) - cc::DOUBLE/nullif(nc, 0))) + 1e-9, 6) AS ks_statistic
       FROM st GROUP BY 1""",
)
def ks_unrounded(spark, d):
    from dayscout.operators.timeseries import rolling_raw

    samples = rolling_raw(c.obs(spark, d)).select(
        "city", "temp_mean_7d", (F.col("date") >= dt.date(1998, 6, 1)).alias("cur")
    )
    found = ks_two_sample(samples, ["city"], "temp_mean_7d", "cur")
    return found.select("city", c.r6("ks_statistic").alias("ks_statistic"))


@check(
    "two_sample_summary",
    f"""WITH {DRIFT_REPLAY_SQL} SELECT check_date, metric_name, baseline_n, current_n,
        round(baseline_mean + 1e-9, 6) AS baseline_mean, round(current_mean + 1e-9, 6) AS current_mean,
        round(baseline_std + 1e-9, 6) AS baseline_std FROM summary""",
)
def summary(spark, d):
    samples = drift.replayed_samples(c.features(spark, d))
    found = two_sample_summary(samples, ["check_date", "metric_name"], "value", "is_current")
    return found.select(
        "check_date", "metric_name", "baseline_n", "current_n",
        *[c.r6(x).alias(x) for x in ("baseline_mean", "current_mean", "baseline_std")],
    )


@check(
    "run_history_stats",
    f"""WITH {HISTORY_SQL} SELECT model_type, metric_name, n_runs,
        round(historical_mean + 1e-9, 6) AS historical_mean, round(historical_std + 1e-9, 6) AS historical_std
        FROM history""",
)
def run_history_stats(spark, d):
    return history_stats(c.runs(spark, d)).select(
        "model_type", "metric_name", "n_runs",
        *[c.r6(x).alias(x) for x in ("historical_mean", "historical_std")],
    )


@check(
    "target_stats",
    """SELECT count(comfort_score) AS n, round(avg(comfort_score) + 1e-9, 6) AS mean,
         round(stddev_pop(comfort_score) + 1e-9, 6) AS std, min(comfort_score) AS min,
         max(comfort_score) AS max FROM features""",
)
def target_stats(spark, d):
    stats = ops.target_stats(c.features(spark, d))
    return stats.withColumn("mean", c.r6("mean")).withColumn("std", c.r6("std"))


METRICS_SQL = """round(sqrt(avg((predicted-actual)*(predicted-actual))) + 1e-9, 6) AS rmse,
  round(avg(abs(predicted-actual)) + 1e-9, 6) AS mae,
  round(1 - sum((predicted-actual)*(predicted-actual))/nullif(var_pop(actual)*count(*), 0) + 1e-9, 6) AS r2,
  count(*) AS n_samples"""


@check(
    "regression_metrics",
    f"WITH {PREDICTED_SQL} SELECT city, {METRICS_SQL} FROM predicted GROUP BY 1",
)
def regression_metrics(spark, d):
    """Of the literal linear score, per place."""
    rows = predicted(spark, d).withColumnRenamed("comfort_score", "actual")
    found = ops.regression_metrics(rows, group=["city"], digits=None)
    return found.select("city", *[c.r6(x).alias(x) for x in ("rmse", "mae", "r2")], "n_samples")


@check(
    "pois_per_place",
    """SELECT p.city, count(h.city) AS n_pois, count(h.city) < 5 AS too_few
       FROM (SELECT city FROM places UNION ALL SELECT city||' (new)' FROM places) p
       LEFT JOIN pois h ON p.city = h.city GROUP BY 1""",
)
def pois_per_place(spark, d):
    """All lodgings; every place has a new neighbour that has none."""
    places = c.places(spark, d)
    new = places.withColumn("city", F.concat("city", F.lit(" (new)")))
    return ops.pois_per_place(places.unionByName(new), c.pois(spark, d))


@check(
    "dedup_first",
    """SELECT city, hotel_name, stars FROM
         (SELECT city, hotel_name, stars FROM pois UNION ALL
          SELECT city, hotel_name, coalesce(stars, 0)+1 FROM pois)
       QUALIFY row_number() OVER (PARTITION BY city, hotel_name ORDER BY stars DESC NULLS LAST) = 1""",
)
def dedup_first(spark, d):
    one = c.pois(spark, d).select("city", "hotel_name", "stars")
    again = one.withColumn("stars", F.coalesce("stars", F.lit(0)) + 1)
    return one_per_key(
        one.unionByName(again), ["city", "hotel_name"], [F.col("stars").desc_nulls_last()]
    )


@check(
    "distinct_dates",
    """SELECT DISTINCT recommendation_date FROM recs_all WHERE profile_name = 'leisure'
       ORDER BY 1 DESC LIMIT 30""",
)
def distinct_dates(spark, d):
    return ops.recommendation_dates(c.recs_all(spark, d), "leisure")


@check(
    "argmax_place",
    """SELECT (SELECT city FROM features ORDER BY comfort_score DESC, city LIMIT 1) AS city,
         round(avg(comfort_score) + 1e-9, 6) AS avg_score, max(comfort_score) AS max_score FROM features""",
)
def argmax_place(spark, d):
    return ops.best_place(c.features(spark, d)).withColumn("avg_score", c.r6("avg_score"))


@check(
    "training_extent",
    """SELECT min(feature_date) AS first_date, max(feature_date) AS last_date, count(*) AS n_rows,
         count(DISTINCT city) AS n_places FROM features""",
)
def training_extent(spark, d):
    return ops.extent(c.features(spark, d))


@check(
    "drift_alert_counts",
    f"""WITH {DRIFT_BY_PLACE_SQL} SELECT metric_name||':'||city AS metric_name,
          count(*) AS drift_count FROM log WHERE drift_detected GROUP BY 1""",
)
def drift_alert_counts(spark, d):
    return ops.drift_alerts(drift_log_by_place(spark, d))


@check(
    "recs_per_profile",
    """SELECT profile_name, count(*) AS n_recommendations,
         round(avg(comfort_score_pred) + 1e-9, 6) AS avg_score FROM recs_all GROUP BY 1""",
)
def recs_per_profile(spark, d):
    found = ops.recommendations_per_profile(c.recs_all(spark, d))
    return found.withColumn("avg_score", c.r6("avg_score"))
