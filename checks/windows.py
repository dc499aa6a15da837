"""Window functions, ordered analysis, sorts and limits."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check
from checks.expressions import PREDICTED_SQL, RULE_SQL, predicted
from checks.sinks import DRIFT_BY_PLACE_SQL, drift_log_by_place
from dayscout.functions.scoring import absolute_error
from dayscout.operators import runlog
from dayscout.operators.aggregates import cluster_stats
from dayscout.operators.learning import elbow, inertia_for_centroids
from dayscout.operators.ranking import (
    by_score,
    by_stars,
    by_stars_zero,
    rank_clusters,
    rank_within,
    top_k,
    top_n,
)
from dayscout.operators.timeseries import latest_per_place
from dayscout.plans.recommend import pivot_top3, rule_scores, top3_by_profile
from dayscout.schemas import CLUSTER_FEATURES

_FEATS = (
    "city, feature_date, temp_mean_7d, temp_mean_3d, precip_sum_7d, precip_sum_3d,"
    " wind_max_7d, wind_max_3d, comfort_score"
)


@check("rolling_features", f"SELECT {_FEATS} FROM features")
def rolling(spark, d):
    return c.features(spark, d)


@check(
    "latest_per_place",
    """SELECT city, (SELECT d FROM job_date) AS feature_date, feature_date AS observed_date,
         temp_mean_7d, temp_mean_3d, precip_sum_7d, precip_sum_3d, wind_max_7d, wind_max_3d,
         comfort_score FROM features
       QUALIFY row_number() OVER (PARTITION BY city ORDER BY feature_date DESC) = 1""",
)
def latest(spark, d):
    return latest_per_place(c.features(spark, d), c.as_of(spark, d))


@check(
    "rank_places",
    """SELECT feature_date, profile_name, city, comfort_score, CAST(row_number() OVER
         (PARTITION BY feature_date, profile_name ORDER BY comfort_score DESC, city) AS INTEGER) AS rank
       FROM scores""",
)
def rank_places(spark, d):
    ranked = rank_within(c.scores(spark, d), ["feature_date", "profile_name"], "comfort_score")
    return ranked.select("feature_date", "profile_name", "city", "comfort_score", "rank")


@check(
    "rank_places_whole",
    """SELECT profile_name, city, feature_date, comfort_score, CAST(row_number() OVER
         (PARTITION BY profile_name ORDER BY comfort_score DESC, city||'|'||feature_date) AS INTEGER) AS rank
       FROM scores""",
)
def rank_places_whole(spark, d):
    """One group per profile over the whole history: the hot-group case."""
    rows = c.scores(spark, d).withColumn(
        "entry", F.concat_ws("|", "city", F.col("feature_date").cast("string"))
    )
    ranked = rank_within(rows, ["profile_name"], "comfort_score", tie="entry")
    return ranked.select("profile_name", "city", "feature_date", "comfort_score", "rank")


@check(
    "rank_clusters",
    """WITH st AS (SELECT feature_date, cluster_id, avg(temp_mean_7d) t, avg(precip_sum_7d) p,
         avg(wind_max_7d) w FROM clustered GROUP BY 1, 2)
       SELECT feature_date, cluster_id, CAST(row_number() OVER (PARTITION BY feature_date ORDER BY
         50*exp(-0.5*((t-18)/6)*((t-18)/6)) + 30*exp(-p/10) + 20*exp(-w/20) DESC, cluster_id)
         AS INTEGER) AS cluster_rank FROM st""",
)
def clusters_ranked(spark, d):
    stats = cluster_stats(c.clustered(spark, d), ["feature_date"])
    ranked = rank_clusters(stats, "gauss", ["feature_date"])
    return ranked.select("feature_date", "cluster_id", "cluster_rank")


@check(
    "topk_pois_per_place",
    """SELECT city, hotel_name, stars FROM pois QUALIFY row_number() OVER
         (PARTITION BY city ORDER BY coalesce(stars, 0) DESC, hotel_name) <= 10""",
)
def topk_pois_per_place(spark, d):
    rows = c.pois(spark, d).select("city", "hotel_name", "stars")
    return top_k(rows, ["city"], by_stars_zero(), 10)


# Two more centroids than the clustering uses, for a longer inertia curve.
CURVE = [*c.CENTROIDS, (30.0, 15.0, 20.0), (10.0, 45.0, 35.0)]


def _inertia_sql() -> str:
    t, p, w = CLUSTER_FEATURES
    dist = [f"(({t}-{x})*({t}-{x})+({p}-{y})*({p}-{y})+({w}-{z})*({w}-{z}))" for x, y, z in CURVE]
    rows = " UNION ALL ".join(
        f"SELECT {k} AS k, sum(least({', '.join(dist[:k])})) AS inertia FROM clustered"
        for k in range(1, 7)
    )
    return f"""curve AS ({rows}), bend AS (SELECT k, lead(inertia, 2) OVER (ORDER BY k)
      - 2*lead(inertia) OVER (ORDER BY k) + inertia AS b FROM curve)"""


@check(
    "elbow_second_difference",
    f"""WITH {_inertia_sql()} SELECT CAST(k+2 AS INTEGER) AS elbow_k, round(b, 3) AS second_difference
        FROM bend WHERE b IS NOT NULL ORDER BY b DESC, k LIMIT 1""",
)
def elbow_second_difference(spark, d):
    curve = inertia_for_centroids(c.features(spark, d), CURVE, range(1, 7))
    return elbow(curve).withColumn("second_difference", F.round("second_difference", 3))


@check(
    "last_n_runs",
    """SELECT model_type, metric_name, created_at, run_id, metric_value FROM runs_plain
       QUALIFY row_number() OVER (PARTITION BY model_type, metric_name
         ORDER BY created_at DESC, run_id DESC) <= 10""",
)
def last_n_runs(spark, d):
    return runlog.last_runs(c.runs_plain(spark, d)).select(
        "model_type", "metric_name", "created_at", "run_id", "metric_value"
    )


@check(
    "current_champion",
    """SELECT model_type, metric_name, metric_value, created_at, run_id FROM runs WHERE is_champion
       QUALIFY row_number() OVER (PARTITION BY model_type ORDER BY created_at DESC, run_id DESC) = 1""",
)
def current_champion(spark, d):
    return runlog.current_champion(c.runs(spark, d))


@check(
    "champion_challenger",
    """SELECT model_type, CAST(sequence AS INTEGER) AS sequence, created_at, run_id, metric_value,
       replaced_by, is_champion FROM promotions""",
)
def champion_challenger(spark, d):
    return runlog.promotions(c.runs_plain(spark, d))


@check(
    "top3_by_profile",
    """SELECT recommendation_date, profile_name, rank, city, comfort_score_pred FROM recs_all
       WHERE rank <= 3""",
)
def top3(spark, d):
    found = top3_by_profile(c.recs_all(spark, d), ["recommendation_date", "profile_name", "rank"])
    return found.select("recommendation_date", "profile_name", "rank", "city", "comfort_score_pred")


_PIVOT = ", ".join(
    f"max(city) FILTER (WHERE profile_name = '{p.profile_name}') AS {p.profile_name}"
    for p in c.PROFILES
)


@check(
    "top3_pivot",
    f"SELECT recommendation_date, rank, {_PIVOT} FROM recs_all WHERE rank <= 3 GROUP BY 1, 2",
)
def top3_pivot(spark, d):
    return pivot_top3(c.recs_all(spark, d), [p.profile_name for p in c.PROFILES])


@check(
    "drift_trend",
    f"""WITH {DRIFT_BY_PLACE_SQL} SELECT metric_name||':'||city AS metric_name, check_date,
          round(ks_statistic + 1e-9, 6) AS drift_score,
          round(ks_statistic - lag(ks_statistic) OVER (PARTITION BY city, metric_name
            ORDER BY check_date) + 1e-9, 6) AS change, drift_detected FROM log""",
)
def drift_trend(spark, d):
    from pyspark.sql import Window

    log = drift_log_by_place(spark, d)
    before = F.lag("drift_score").over(Window.partitionBy("metric_name").orderBy("check_timestamp"))
    return log.select(
        "metric_name",
        F.col("check_timestamp").cast("date").alias("check_date"),
        c.r6("drift_score").alias("drift_score"),
        c.r6(F.col("drift_score") - before).alias("change"),
        "drift_detected",
    )


@check(
    "champion_for_drift",
    """WITH newest AS (SELECT *, row_number() OVER (PARTITION BY model_type, metric_name
         ORDER BY created_at DESC, run_id DESC) AS n FROM runs QUALIFY n <= 10)
       SELECT model_type, metric_name, coalesce(max(metric_value) FILTER (WHERE is_champion),
         max(metric_value) FILTER (WHERE n = 1)) AS champion_value FROM newest GROUP BY 1, 2""",
)
def champion_for_drift(spark, d):
    return runlog.history_stats(c.runs(spark, d)).select(
        "model_type", "metric_name", "champion_value"
    )


# --- sorts and limits -------------------------------------------------------------


@check(
    "top_n_places",
    """SELECT city, comfort_score, temp_mean_3d, precip_sum_3d FROM daily_features
       ORDER BY comfort_score DESC, city LIMIT 5""",
)
def top_n_places(spark, d):
    rows = c.daily_features(spark, d).select(
        "city", "comfort_score", "temp_mean_3d", "precip_sum_3d"
    )
    return top_n(rows, by_score("comfort_score"), 5)


@check(
    "top_n_predicted",
    f"""WITH {PREDICTED_SQL} SELECT city, feature_date, round(predicted + 1e-9, 6) AS predicted,
          round(abs(predicted-actual) + 1e-9, 6) AS error FROM predicted
        ORDER BY predicted.predicted DESC, city, feature_date LIMIT 5""",
)
def top_n_predicted(spark, d):
    rows = predicted(spark, d)
    best = top_n(rows, [*by_score("predicted"), F.col("feature_date")], 5)
    error = absolute_error(F.col("predicted"), F.col("comfort_score"))
    return best.select(
        "city", "feature_date", c.r6("predicted").alias("predicted"),
        c.r6(error).alias("error"),
    )


@check(
    "order_nulls_last",
    """SELECT city, hotel_name, hotel_type, stars FROM pois
       ORDER BY stars DESC NULLS LAST, hotel_name LIMIT 25""",
)
def order_nulls_last(spark, d):
    rows = c.pois(spark, d).select("city", "hotel_name", "hotel_type", "stars")
    return top_n(rows, by_stars(), 25)


@check("order_multi_key", f"SELECT {_FEATS} FROM features ORDER BY feature_date DESC, city")
def order_multi_key(spark, d):
    return c.features(spark, d).orderBy(F.col("feature_date").desc(), "city")


@check("top_n_rule_scores", f"SELECT * FROM ({RULE_SQL} FROM daily_features) ORDER BY score DESC, city LIMIT 10")
def top_n_rule_scores(spark, d):
    return top_n(rule_scores(c.daily_features(spark, d)), by_score("score"), 10)
