"""Composite jobs."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check, profile_sql
from checks.expressions import HISTORY_SQL, RULE_SQL
from checks.joins import DISTANCE_SQL, STALE_SQL
from checks.learning import champions
from dayscout.operators import learning as ml
from dayscout.operators.runlog import model_drift
from dayscout.plans import dashboard, drift, enrich, features, ingest, recommend, retrain
from dayscout.sources.dims import SEED_PROFILES
from dayscout.sources.files import scratch_dir

_OBS = (
    "city, date, temp_max, temp_min, temp_mean, precipitation, wind_speed_max,"
    " wind_gusts_max, weather_code"
)


def _moved(spark, d):
    """The observations three days later and two degrees warmer: the next payloads."""
    rows = c.obs(spark, d)
    return (
        rows.withColumn("date", F.date_add("date", 3))
        .withColumn("temp_max", F.col("temp_max") + 2)
        .withColumn("temp_min", F.col("temp_min") + 2)
    )


def _ingested(spark, d):
    """Every payload comes twice; the warmer one was received first and must lose."""
    moved = _moved(spark, d)
    warmer = moved.withColumns({t: F.col(t) + 7 for t in ("temp_max", "temp_min")})
    received = [(warmer, "2002-01-01 06:00:00"), (moved, "2002-01-01 18:00:00")]
    first, second = (
        c.payloads(spark, d, rows).withColumn("fetched_at", F.lit(at).cast("timestamp"))
        for rows, at in received
    )
    batch = first.unionByName(second)
    return ingest.ingest(c.obs(spark, d), batch, [F.col("fetched_at").desc()])


_STATE = """batch AS (SELECT city, date+3 AS date, temp_max+2 AS temp_max, temp_min+2 AS temp_min,
    (temp_max+2+temp_min+2)/2 AS temp_mean, precipitation, wind_speed_max, wind_gusts_max,
    weather_code FROM obs),
  state AS (SELECT * FROM batch UNION ALL BY NAME SELECT * FROM obs ANTI JOIN batch USING (city, date))"""


@check("ingest_observations", f"WITH {_STATE} SELECT {_OBS} FROM state")
def ingest_observations(spark, d):
    return _ingested(spark, d)


@check(
    "ingest_quality",
    f"""WITH {_STATE} SELECT count(DISTINCT city) AS city_count, count(DISTINCT city) < 20 AS below_expected,
          count(*) FILTER (WHERE date >= (SELECT d FROM job_date) AND temp_mean IS NULL) AS null_count,
          count(*) FILTER (WHERE date >= (SELECT d FROM job_date) AND
            (temp_mean < -20 OR temp_mean > 50 OR precipitation > 200)) AS outlier_count,
          count(*) FILTER (WHERE date >= (SELECT d FROM job_date)) AS n_recent FROM state""",
)
def ingest_quality(spark, d):
    return ingest.quality_report(_ingested(spark, d), c.as_of(spark, d))


_SEEDED = ", ".join(f"'{p.profile_name}'" for p in SEED_PROFILES)
_DAILY = f"""recent AS (SELECT * FROM obs WHERE date >= (SELECT d FROM job_date) - 30),
  win AS (SELECT city, date,
    round(avg(temp_mean) OVER w7, 2) temp_mean_7d, round(avg(temp_mean) OVER w3, 2) temp_mean_3d,
    sum(precipitation) OVER w7 precip_sum_7d, sum(precipitation) OVER w3 precip_sum_3d,
    max(wind_speed_max) OVER w7 wind_max_7d, max(wind_speed_max) OVER w3 wind_max_3d FROM recent
    WINDOW w7 AS (PARTITION BY city ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
           w3 AS (PARTITION BY city ORDER BY date RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW)),
  newest AS (SELECT * FROM win QUALIFY row_number() OVER (PARTITION BY city ORDER BY date DESC) = 1),
  daily_scores AS (SELECT f.city, (SELECT d FROM job_date) AS feature_date, q.profile_name,
    round({profile_sql('f.temp_mean_3d', 'f.precip_sum_3d', 'f.wind_max_3d')}, 2) AS comfort_score
    FROM newest f CROSS JOIN profiles q WHERE q.profile_name IN ({_SEEDED}))"""


@check(
    "compute_features",
    f"""WITH {_DAILY} SELECT n.city, s.feature_date, temp_mean_7d, temp_mean_3d, precip_sum_7d,
          precip_sum_3d, wind_max_7d, wind_max_3d, s.comfort_score
        FROM newest n JOIN daily_scores s ON s.city = n.city AND s.profile_name = 'leisure'""",
)
def compute_features(spark, d):
    return features.compute_daily(c.obs(spark, d), c.as_of(spark, d)).features


@check(
    "compute_features_scores",
    f"""WITH {_DAILY} SELECT city, feature_date, profile_name, comfort_score FROM daily_scores
        UNION ALL SELECT * FROM (SELECT city, feature_date, profile_name, comfort_score FROM scores
          WHERE profile_name IN ({_SEEDED})) o
        ANTI JOIN daily_scores USING (city, feature_date, profile_name)""",
)
def compute_features_scores(spark, d):
    """The score table after the daily upsert."""
    from dayscout.operators.profiles import score_profiles

    rows = c.features(spark, d)
    daily = features.compute_daily(c.obs(spark, d), c.as_of(spark, d))
    return features.store_daily(daily, rows, score_profiles(rows)).scores


@check(
    "backfill_features",
    """SELECT city, feature_date, observed_date, temp_mean_7d, temp_mean_3d, precip_sum_7d,
         precip_sum_3d, wind_max_7d, wind_max_3d, comfort_score
       FROM carried ANTI JOIN features USING (city, feature_date)""",
)
def backfill_features(spark, d):
    return features.backfill(c.obs(spark, d), c.features(spark, d))


@check("retrain")
def retrain_job(spark, d):
    rows, runs = c.features(spark, d), c.runs(spark, d)
    root = scratch_dir(spark, "retrain")
    result = retrain.retrain(rows, runs, c.as_of(spark, d), root, run_id=10**9, partitions=2)
    return result.log.groupBy("model_type", "is_champion").agg(
        F.count("*").alias("n_runs"), F.max("run_id").alias("last_run")
    )


_REC = "recommendation_date, city, profile_name, cluster_id, comfort_score_pred, rank"


@check("recommend_profiles", f"SELECT {_REC} FROM recs_daily")
def recommend_profiles(spark, d):
    from dayscout.operators.profiles import score_profiles

    rows = c.daily_features(spark, d)
    return recommend.recommend_profiles(
        rows, score_profiles(rows, c.PROFILES), c.as_of(spark, d), c.assign
    )


@check("recommend_profiles_history", f"SELECT {_REC} FROM recs_all")
def recommend_profiles_history(spark, d):
    return c.recs_all(spark, d)


@check("recommend_predicted")
def recommend_predicted(spark, d):
    clusters, regression = champions(spark, d)
    return recommend.recommend_predicted(
        c.daily_features(spark, d),
        c.as_of(spark, d),
        lambda rows: ml.assign_clusters(clusters, rows),
        lambda rows: ml.predict_clipped(regression, rows),
    )


@check(
    "recommend_rules",
    f"""WITH today AS ({RULE_SQL} FROM daily_features
          WHERE temp_mean_7d IS NOT NULL AND temp_mean_3d IS NOT NULL),
        old AS ({RULE_SQL} FROM features)
        SELECT * FROM today UNION ALL SELECT * FROM old
        WHERE recommendation_date >= (SELECT d FROM job_date) - 7
          AND recommendation_date <> (SELECT d FROM job_date)""",
)
def recommend_rules(spark, d):
    old = recommend.rule_scores(c.features(spark, d))
    return recommend.recommend_rules(c.daily_features(spark, d), c.as_of(spark, d), old)


_POI = (
    "city, hotel_name, hotel_type, stars, address, latitude, longitude, website_url, amenities,"
    " data_source, fetched_at"
)


@check(
    "enrich_pois",
    f"""WITH {STALE_SQL},
        near AS (SELECT p.city AS place, h.* FROM places p SEMI JOIN chosen USING (city)
          JOIN parsed_pois h ON {DISTANCE_SQL} <= 8000),
        best AS (SELECT place AS city, hotel_name, hotel_type, stars, address, latitude, longitude,
          website_url, amenities, data_source, (SELECT d FROM job_date) AS fetched_at FROM near
          QUALIFY row_number() OVER (PARTITION BY place ORDER BY coalesce(stars, 0) DESC, hotel_name) <= 10)
        SELECT {_POI} FROM best UNION ALL
        SELECT city, hotel_name, hotel_type, stars, NULL, latitude, longitude, website_url, amenities,
          NULL, fetched_at FROM pois ANTI JOIN best USING (city, hotel_name)""",
)
def enrich_pois(spark, d):
    old = c.pois(spark, d).withColumn("address", F.lit(None).cast("string")).withColumn(
        "data_source", F.lit(None).cast("string")
    )
    elements = c.elements(spark, d).select("element")
    state = enrich.enrich(
        c.recs_daily(spark, d), c.places(spark, d), old, elements, c.as_of(spark, d)
    )
    return state.select(*[x.strip() for x in _POI.split(",")])


# The two samples of a check on the job date, per metric.
_SAMPLES = """long AS (SELECT feature_date, 'temp_mean_3d' AS m, temp_mean_3d AS v FROM features
    UNION ALL SELECT feature_date, 'precip_sum_3d', precip_sum_3d FROM features
    UNION ALL SELECT feature_date, 'wind_max_3d', wind_max_3d FROM features
    UNION ALL SELECT feature_date, 'leisure', comfort_score FROM scores WHERE profile_name = 'leisure'),
  sm AS (SELECT m, v, FALSE AS cur FROM long WHERE v IS NOT NULL AND feature_date
      BETWEEN (SELECT d FROM job_date) - 35 AND (SELECT d FROM job_date) - 7
    UNION ALL SELECT m, v, TRUE FROM long WHERE v IS NOT NULL AND feature_date >= (SELECT d FROM job_date) - 7),
  zs AS (SELECT *, count(*) FILTER (WHERE NOT cur) OVER (PARTITION BY m) nb,
      count(*) FILTER (WHERE cur) OVER (PARTITION BY m) nc FROM sm),
  stp AS (SELECT m, nb, nc, count(*) FILTER (WHERE NOT cur) OVER o cb, count(*) FILTER (WHERE cur) OVER o cc
    FROM zs WINDOW o AS (PARTITION BY m ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  kst AS (SELECT m, max(abs(cb::DOUBLE/nullif(nb, 0)-cc::DOUBLE/nullif(nc, 0))) k FROM stp GROUP BY 1),
  smr AS (SELECT m, count(*) FILTER (WHERE NOT cur) baseline_n, count(*) FILTER (WHERE cur) current_n,
    avg(v) FILTER (WHERE NOT cur) bm, avg(v) FILTER (WHERE cur) cm, stddev_pop(v) FILTER (WHERE NOT cur) bs
    FROM sm GROUP BY 1),
  cmp AS (SELECT smr.*, k, CASE WHEN bs > 0 THEN abs(cm-bm)/bs ELSE 0 END AS shift,
    CASE m WHEN 'temp_mean_3d' THEN 0.35::DOUBLE WHEN 'precip_sum_3d' THEN 0.5::DOUBLE
      ELSE 0.4::DOUBLE END AS threshold FROM smr JOIN kst USING (m))"""


@check(
    "feature_drift",
    f"""WITH {_SAMPLES} SELECT m AS metric_name, baseline_n, current_n, round(bm + 1e-9, 6) AS baseline_mean,
          round(cm + 1e-9, 6) AS current_mean, round(k + 1e-9, 6) AS ks_statistic, round(shift + 1e-9, 6) AS mean_shift_std,
          threshold, k > threshold OR shift > 2.5 AS drift_detected FROM cmp WHERE m <> 'leisure'""",
)
def feature_drift(spark, d):
    found = drift.detect_feature_drift(c.features(spark, d), c.as_of(spark, d))
    rounded = ("baseline_mean", "current_mean", "ks_statistic", "mean_shift_std")
    return found.select(
        "metric_name", "baseline_n", "current_n", *[c.r6(x).alias(x) for x in rounded],
        "threshold", "drift_detected",
    )


@check(
    "model_drift",
    f"""WITH {HISTORY_SQL} SELECT model_type, metric_name, n_runs,
          round((historical_mean-champion_value)/historical_mean + 1e-9, 6) AS performance_drop,
          (historical_mean-champion_value)/historical_mean > 0.1 AS drift_detected FROM history""",
)
def model_drift_job(spark, d):
    return model_drift(c.runs(spark, d)).select(
        "model_type", "metric_name", "n_runs",
        c.r6("performance_drop").alias("performance_drop"), "drift_detected",
    )


@check(
    "prediction_drift",
    f"""WITH {_SAMPLES} SELECT m AS profile_name, baseline_n, current_n, round(bm + 1e-9, 6) AS baseline_mean,
          round(cm + 1e-9, 6) AS current_mean, round(k + 1e-9, 6) AS ks_statistic, k > 0.4 AS drift_detected
        FROM cmp WHERE m = 'leisure'""",
)
def prediction_drift(spark, d):
    found = drift.detect_prediction_drift(c.scores(spark, d), c.as_of(spark, d))
    rounded = ("baseline_mean", "current_mean", "ks_statistic")
    return found.select(
        "profile_name", "baseline_n", "current_n", *[c.r6(x).alias(x) for x in rounded],
        "drift_detected",
    )


_CHECKS = f"""{_SAMPLES}, {HISTORY_SQL},
  all_checks AS (SELECT 'feature_drift' AS section, m AS name, k AS score,
      k > threshold OR shift > 2.5 AS drift_detected FROM cmp WHERE m <> 'leisure'
    UNION ALL SELECT 'model_drift', model_type, (historical_mean-champion_value)/historical_mean,
      (historical_mean-champion_value)/historical_mean > 0.1 FROM history
    UNION ALL SELECT 'prediction_drift', m, k, k > 0.4 FROM cmp WHERE m = 'leisure')"""


def _checks(spark, d):
    return drift.drift_checks(
        c.features(spark, d), c.runs(spark, d), c.scores(spark, d), c.as_of(spark, d)
    )


@check(
    "drift_report",
    f"WITH {_CHECKS} SELECT section, name, round(score + 1e-9, 6) AS score, drift_detected FROM all_checks",
)
def drift_report(spark, d):
    return _checks(spark, d).select(
        "section", "name", c.r6("score").alias("score"), "drift_detected"
    )


@check(
    "drift_report_json",
    f"""WITH {_CHECKS}
        SELECT 'feature_drift' AS section, m AS name, k > threshold OR shift > 2.5 AS drift_detected,
          round(k + 1e-9, 6) AS statistic, round(bm + 1e-9, 6) AS baseline, round(cm + 1e-9, 6) AS current,
          round(shift + 1e-9, 6) AS shift,
          CAST(k > threshold AS INT) + CAST(shift > 2.5 AS INT) AS n_reasons FROM cmp WHERE m <> 'leisure'
        UNION ALL SELECT 'model_drift', model_type, (historical_mean-champion_value)/historical_mean > 0.1,
          round((historical_mean-champion_value)/historical_mean + 1e-9, 6),
          round(historical_mean + 1e-9, 6), round(champion_value + 1e-9, 6), NULL, NULL FROM history
        UNION ALL SELECT 'prediction_drift', m, k > 0.4, round(k + 1e-9, 6), round(bm + 1e-9, 6),
          round(cm + 1e-9, 6), NULL, NULL FROM cmp WHERE m = 'leisure'""",
)
def drift_report_json(spark, d):
    """The figures of the published file."""
    when = c.as_of(spark, d)
    report = drift.run_report(
        spark, lambda: c.features(spark, d), lambda: c.runs(spark, d), lambda: c.scores(spark, d), when, f"{when}T00:00:00"
    )
    path = drift.write_report(spark, report, scratch_dir(spark, "reports"), f"{when:%Y%m%d}_000000")
    figures = {
        "statistic": F.coalesce("ks_statistic", "performance_drop"),
        "baseline": F.coalesce("baseline_mean", "historical_mean"),
        "current": F.coalesce("current_mean", "champion_value"),
        "shift": F.col("mean_shift_std"),
    }
    found = drift.read_reports(spark, path).withColumns(figures)
    return found.select(
        "section", "name", "drift_detected", *[c.r6(x).alias(x) for x in figures],
        F.when(F.col("section") == "feature_drift", F.size("reasons")).alias("n_reasons"),
    )


@check("train_models")
def train_models(spark, d):
    """The stand-alone training, clusters of the newest date and regressors over all history: both
    saved models, by their cards, and how they do on the newest date."""
    trained = retrain.train_models(c.features(spark, d), scratch_dir(spark, "models"), c.as_of(spark, d))
    today = trained.newest.agg(
        F.round(F.avg("error"), 6).alias("newest_mae"), F.count("*").alias("newest_rows")
    ).first()
    rows = [
        (k.kind, k.model_type, ", ".join(k.feature_names), k.trained_at, k.k, m, float(v))
        for k in (trained.clusters, trained.regression)
        for m, v in sorted(k.metrics.items())
        if isinstance(v, int | float)
    ]
    schema = "kind string, model_type string, feature_names string, trained_at string, k int, metric string, value double"
    return spark.createDataFrame(rows, schema).select(
        "*", F.lit(today["newest_mae"]).alias("newest_mae"), F.lit(today["newest_rows"]).alias("newest_rows")
    )


@check(
    "drift_overall",
    f"""WITH {_CHECKS} SELECT bool_or(drift_detected) AS overall_drift_detected,
          bool_or(drift_detected AND section <> 'prediction_drift') AS needs_retraining,
          count(*) FILTER (WHERE drift_detected) AS n_drifted FROM all_checks""",
)
def drift_overall(spark, d):
    found = drift.drift_overall(_checks(spark, d))
    return found.select("overall_drift_detected", "needs_retraining", "n_drifted")


def _dashboard(spark, d):
    return dashboard.dashboard(
        c.recs_all(spark, d), c.places(spark, d), c.scores(spark, d), c.features(spark, d),
        c.pois(spark, d), c.runs(spark, d), c.as_of(spark, d), "leisure",
    )


_ON_DAY = "recommendation_date = (SELECT d FROM job_date) AND profile_name = 'leisure'"


@check(
    "dashboard_extract",
    f"""SELECT r.city, r.rank, r.comfort_score_pred, r.cluster_id, p.latitude, p.longitude,
          s.comfort_score AS actual_score, f.temp_mean_3d, f.precip_sum_3d, f.wind_max_3d
        FROM (SELECT * FROM recs_all WHERE {_ON_DAY} AND rank <= 10) r JOIN places p ON p.city = r.city
        LEFT JOIN scores s ON s.city = r.city AND s.feature_date = r.recommendation_date
          AND s.profile_name = r.profile_name
        LEFT JOIN features f ON f.city = r.city AND f.feature_date = r.recommendation_date
          AND r.rank <= 5 ORDER BY r.rank""",
)
def dashboard_extract(spark, d):
    return _dashboard(spark, d).recommendations.select(
        "city", "rank", "comfort_score_pred", "cluster_id", "latitude", "longitude",
        "actual_score", "temp_mean_3d", "precip_sum_3d", "wind_max_3d",
    )


@check(
    "dashboard_lodgings",
    f"""SELECT city, hotel_name, stars FROM pois WHERE city IN
          (SELECT city FROM recs_all WHERE {_ON_DAY} AND rank <= 5)
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY stars DESC NULLS LAST, hotel_name) <= 5""",
)
def dashboard_lodgings(spark, d):
    return _dashboard(spark, d).lodgings.select("city", "hotel_name", "stars")
