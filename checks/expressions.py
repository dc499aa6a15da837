"""Projections, predicates and scoring expressions."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check, comfort_sql, profile_sql
from checks.sinks import DRIFT_BY_PLACE_SQL
from dayscout.functions import drift_rules as rules
from dayscout.functions import scoring
from dayscout.operators.aggregates import cluster_stats, outliers
from dayscout.operators.profiles import score_profiles
from dayscout.operators.runlog import history_stats
from dayscout.operators.timeseries import rolling_raw
from dayscout.plans import drift
from dayscout.plans.recommend import complete, rule_scores
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES, REGRESSION_TARGET


@check("temp_midrange", "SELECT city, date, (temp_max+temp_min)/2 AS temp_mean FROM obs")
def temp_midrange(spark, d):
    mean = scoring.midrange(F.col("temp_max"), F.col("temp_min"))
    return c.obs(spark, d).select("city", "date", mean.alias("temp_mean"))


_RAW3 = ("temp_mean_3d", "precip_sum_3d", "wind_max_3d")


@check(
    "comfort_score",
    f"SELECT city, feature_date, round({comfort_sql(*_RAW3)} + 1e-9, 6) AS score FROM raw_features",
)
def comfort_score(spark, d):
    score = scoring.comfort_score(*[F.col(x) for x in _RAW3], digits=None)
    return rolling_raw(c.obs(spark, d)).select(
        "city", F.col("date").alias("feature_date"), c.r6(score).alias("score")
    )


_P = profile_sql(*[f"f.{x}" for x in _RAW3])


@check(
    "profile_score",
    f"""SELECT f.city, f.feature_date, q.profile_name, round({_P} + 1e-9, 6) AS comfort_score
        FROM raw_features f CROSS JOIN profiles q""",
)
def profile_score(spark, d):
    raw = rolling_raw(c.obs(spark, d)).withColumnRenamed("date", "feature_date")
    scored = score_profiles(raw, c.PROFILES, digits=None)
    return scored.withColumn("comfort_score", c.r6("comfort_score"))


def _rule_sql(t, p, w):
    return f"""round(0.5*(CASE WHEN {t} >= 18 AND {t} <= 25 THEN 100 WHEN {t} >= 15 AND {t} < 18
      OR {t} > 25 AND {t} <= 28 THEN 80 WHEN {t} >= 10 AND {t} < 15 OR {t} > 28 AND {t} <= 32
      THEN 60 ELSE 30 END)::DOUBLE + 0.3*(CASE WHEN {p} <= 1 THEN 100 WHEN {p} <= 5 THEN 80
      WHEN {p} <= 15 THEN 50 ELSE 20 END)::DOUBLE + 0.2*(CASE WHEN {w} <= 15 THEN 100
      WHEN {w} <= 25 THEN 80 WHEN {w} <= 35 THEN 60 ELSE 30 END)::DOUBLE, 1)"""


RULE_SQL = f"""SELECT feature_date AS recommendation_date, city, {_rule_sql(*_RAW3)} AS score,
  temp_mean_3d AS temperature, precip_sum_3d AS precipitation, wind_max_3d AS wind_speed"""


@check("rule_score", f"{RULE_SQL} FROM features")
def rule_score(spark, d):
    return rule_scores(c.features(spark, d))


_STATS = """st AS (SELECT feature_date, cluster_id, avg(temp_mean_7d) t, avg(precip_sum_7d) p,
  avg(wind_max_7d) w FROM clustered GROUP BY 1, 2)"""


def _daily_cluster_score(spark, d, form):
    stats = cluster_stats(c.clustered(spark, d), ["feature_date"])
    means = [F.col(x) for x in ("avg_temp", "avg_precip", "avg_wind")]
    return stats.select(
        "feature_date", "cluster_id", c.r6(form(*means)).alias("cluster_comfort")
    )


@check(
    "cluster_comfort_gauss",
    f"""WITH {_STATS} SELECT feature_date, cluster_id, round(50*exp(-0.5*((t-18)/6)*((t-18)/6))
        + 30*exp(-p/10) + 20*exp(-w/20) + 1e-9, 6) AS cluster_comfort FROM st""",
)
def cluster_comfort_gauss(spark, d):
    return _daily_cluster_score(spark, d, scoring.cluster_comfort_gauss)


@check(
    "cluster_comfort_linear",
    f"""WITH {_STATS} SELECT feature_date, cluster_id, round(greatest(0, 30-p)
        + greatest(0, 20-abs(t-18)) + greatest(0, 15-w/3) + 1e-9, 6) AS cluster_comfort FROM st""",
)
def cluster_comfort_linear(spark, d):
    return _daily_cluster_score(spark, d, scoring.cluster_comfort_linear)


_A, _T, _Pr, _W = c.LINEAR
LINEAR_SQL = f"({_A}::DOUBLE + {_T}::DOUBLE*temp_mean_3d + {_Pr}::DOUBLE*precip_sum_3d + {_W}::DOUBLE*wind_max_3d)"
_COMPLETE3 = " AND ".join(f"{x} IS NOT NULL" for x in (*_RAW3, "comfort_score"))


def predicted(spark, d, rows=None):
    rows = c.features(spark, d) if rows is None else rows
    ok = complete(rows, [*REGRESSION_FEATURES, REGRESSION_TARGET])
    return c.linear_score(ok).withColumn("predicted", scoring.clip_score(F.col("raw_prediction")))


PREDICTED_SQL = f"""predicted AS (SELECT city, feature_date, comfort_score AS actual,
  greatest(0, least(100, {LINEAR_SQL})) AS predicted FROM features WHERE {_COMPLETE3})"""


@check(
    "clip_predictions",
    f"WITH {PREDICTED_SQL} SELECT city, feature_date, round(predicted + 1e-9, 6) AS predicted FROM predicted",
)
def clip_predictions(spark, d):
    return predicted(spark, d).select(
        "city", "feature_date", c.r6("predicted").alias("predicted")
    )


@check(
    "prediction_error",
    f"""WITH {PREDICTED_SQL} SELECT city, feature_date, round(abs(predicted-actual) + 1e-9, 6) AS error
        FROM predicted""",
)
def prediction_error(spark, d):
    error = scoring.absolute_error(F.col("predicted"), F.col("comfort_score"))
    return predicted(spark, d).select("city", "feature_date", c.r6(error).alias("error"))


def _replayed(spark, d):
    return drift.replay_feature_drift(c.features(spark, d), by=["city"])


@check(
    "severity_tier",
    f"""WITH {DRIFT_BY_PLACE_SQL} SELECT city, check_date, metric_name, round(ks_statistic + 1e-9, 6) AS ks_statistic,
        severity FROM log""",
)
def severity_tier(spark, d):
    tier = rules.severity(F.col("drift_detected"), F.col("ks_statistic"), F.col("threshold"))
    return _replayed(spark, d).where(F.col("reason").isNull()).select(
        "city", "check_date", "metric_name", c.r6("ks_statistic").alias("ks_statistic"),
        tier.alias("severity"),
    )


@check(
    "threshold_route",
    """SELECT metric_name, CASE WHEN metric_name LIKE '%temp%' THEN 0.35::DOUBLE
         WHEN metric_name LIKE '%precip%' THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END AS threshold,
         count(value) AS n_values
       FROM (SELECT 'temp_mean_7d' AS metric_name, temp_mean_7d AS value FROM features
         UNION ALL SELECT 'temp_mean_3d', temp_mean_3d FROM features
         UNION ALL SELECT 'precip_sum_7d', precip_sum_7d FROM features
         UNION ALL SELECT 'precip_sum_3d', precip_sum_3d FROM features
         UNION ALL SELECT 'wind_max_7d', wind_max_7d FROM features
         UNION ALL SELECT 'wind_max_3d', wind_max_3d FROM features
         UNION ALL SELECT 'comfort_score', comfort_score FROM features) GROUP BY 1, 2""",
)
def threshold_route(spark, d):
    """Every stored column with the threshold its name leads to."""
    rows = c.features(spark, d)
    long = rows.unpivot(["city"], rows.columns[2:], "metric_name", "value")
    return long.groupBy(
        "metric_name", rules.ks_threshold(F.col("metric_name")).alias("threshold")
    ).agg(F.count("value").alias("n_values"))


@check(
    "filter_outliers",
    """SELECT city, date, temp_mean, precipitation FROM obs
       WHERE date >= DATE '1998-01-01' AND (temp_mean < -20 OR temp_mean > 50 OR precipitation > 200)
       UNION ALL SELECT city, date, temp_mean * 3, precipitation * 10 FROM obs
       WHERE date >= DATE '1998-01-01'
         AND (temp_mean * 3 < -20 OR temp_mean * 3 > 50 OR precipitation * 10 > 200)""",
)
def filter_outliers(spark, d):
    """The table next to a copy with broken units, from a day on."""
    import datetime as dt

    base = c.obs(spark, d).select("city", "date", "temp_mean", "precipitation")
    broken = base.select(
        "city", "date", (F.col("temp_mean") * 3).alias("temp_mean"),
        (F.col("precipitation") * 10).alias("precipitation"),
    )
    return outliers(base.unionByName(broken), dt.date(1998, 1, 1))


@check(
    "drop_incomplete_kmeans",
    """SELECT city, feature_date, temp_mean_7d, precip_sum_7d, wind_max_7d FROM features
       WHERE temp_mean_7d IS NOT NULL AND precip_sum_7d IS NOT NULL AND wind_max_7d IS NOT NULL""",
)
def drop_incomplete_kmeans(spark, d):
    return complete(
        c.features(spark, d).select("city", "feature_date", *CLUSTER_FEATURES), CLUSTER_FEATURES
    )


@check(
    "drop_incomplete_regression",
    f"SELECT city, feature_date, {', '.join(_RAW3)}, comfort_score FROM features WHERE {_COMPLETE3}",
)
def drop_incomplete_regression(spark, d):
    used = [*REGRESSION_FEATURES, REGRESSION_TARGET]
    return complete(c.features(spark, d).select("city", "feature_date", *used), used)


@check(
    "filter_in_list",
    """SELECT city, feature_date, temp_mean_3d, precip_sum_3d, wind_max_3d FROM daily_features
       WHERE city IN (SELECT city FROM recs_daily WHERE profile_name = 'leisure' AND rank <= 5)""",
)
def filter_in_list(spark, d):
    """Features of the day for the places of a list held in a table."""
    wanted = c.recs_daily(spark, d).where(
        (F.col("profile_name") == "leisure") & (F.col("rank") <= 5)
    )
    rows = c.daily_features(spark, d).select("city", "feature_date", *REGRESSION_FEATURES)
    return rows.join(wanted.select("city"), "city", "left_semi")


@check(
    "mean_shift",
    f"""WITH {DRIFT_BY_PLACE_SQL} SELECT city, check_date, metric_name, round(shift + 1e-9, 6) AS mean_shift
        FROM flagged WHERE baseline_n > 0 AND current_n > 0""",
)
def mean_shift(spark, d):
    return _replayed(spark, d).where(F.col("reason").isNull()).select(
        "city", "check_date", "metric_name", c.r6("mean_shift_std").alias("mean_shift")
    )


@check(
    "feature_drift_flag",
    f"""WITH {DRIFT_BY_PLACE_SQL} SELECT city, check_date, metric_name, drift_detected,
          CAST((ks_statistic > threshold)::INT + (shift > 2.5)::INT AS INTEGER) AS n_reasons
        FROM flagged WHERE baseline_n > 0 AND current_n > 0""",
)
def feature_drift_flag(spark, d):
    return _replayed(spark, d).where(F.col("reason").isNull()).select(
        "city", "check_date", "metric_name", "drift_detected", F.size("reasons").alias("n_reasons")
    )


HISTORY_SQL = """newest AS (SELECT *, row_number() OVER (PARTITION BY model_type, metric_name
    ORDER BY created_at DESC, run_id DESC) AS n FROM runs QUALIFY n <= 10),
history AS (SELECT model_type, metric_name, count(*) AS n_runs, avg(metric_value) AS historical_mean,
    stddev_samp(metric_value) AS historical_std,
    coalesce(max(metric_value) FILTER (WHERE is_champion),
             max(metric_value) FILTER (WHERE n = 1)) AS champion_value
  FROM newest GROUP BY 1, 2)"""


@check(
    "performance_drop",
    f"""WITH {HISTORY_SQL} SELECT model_type, metric_name,
          round((historical_mean-champion_value)/historical_mean + 1e-9, 6) AS performance_drop,
          (historical_mean-champion_value)/historical_mean > 0.1 AS degraded FROM history""",
)
def performance_drop(spark, d):
    drop = rules.performance_drop(F.col("historical_mean"), F.col("champion_value"))
    return history_stats(c.runs(spark, d)).select(
        "model_type", "metric_name", c.r6(drop).alias("performance_drop"),
        rules.performance_degraded(drop).alias("degraded"),
    )
