"""Writes as state changes. The batches are the whole tables moved by some days, so
they overlap the stored rows in part."""

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import common as c
from checks.common import check
from dayscout.operators import writes
from dayscout.operators.aggregates import cluster_breakdown, cluster_stats
from dayscout.operators.learning import assign_clusters, fit_clusters
from dayscout.operators.profiles import score_profiles
from dayscout.operators.runlog import last_runs
from dayscout.plans import drift, retrain
from dayscout.plans.recommend import complete
from dayscout.schemas import (
    CLUSTER_FEATURES,
    MODEL_RUNS,
    OBSERVATIONS,
    POIS,
    PROFILE_SCORES,
    PROFILES,
    RECOMMENDATIONS,
)
from dayscout.sources.dims import profiles_table
from dayscout.sources.files import scratch_dir
from dayscout.sources.models import ModelRegistry
from dayscout.sources.store import Store

_KEY = ["city", "date"]
_COLS = "city, date, temp_max, precipitation"


def _store(spark):
    return Store(spark, scratch_dir(spark, "store"))


def _batch(spark, d):
    """Two revisions of the same days: the later revision must win."""
    base = c.obs(spark, d).select(*_KEY, "temp_max", "precipitation")
    first = base.withColumn("date", F.date_add("date", 3)).withColumn("revision", F.lit(1))
    second = (
        base.withColumn("date", F.date_add("date", 5))
        .withColumn("temp_max", F.col("temp_max") + 100)
        .withColumn("revision", F.lit(2))
    )
    return first.unionByName(second)


_BATCH_SQL = """batch AS (
  SELECT city, date+3 AS date, temp_max, precipitation, 1 AS revision FROM obs UNION ALL
  SELECT city, date+5, temp_max+100, precipitation, 2 FROM obs),
fresh AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY city, date
          ORDER BY revision DESC) = 1)"""


@check(
    "upsert_replace",
    f"""WITH {_BATCH_SQL} SELECT city, date, coalesce(f.temp_max, o.temp_max) AS temp_max,
      coalesce(f.precipitation, o.precipitation) AS precipitation
      FROM obs o FULL JOIN fresh f USING (city, date)""",
)
def upsert_replace(spark, d):
    store = _store(spark)
    store.append(c.obs(spark, d).select(*_KEY, "temp_max", "precipitation"), OBSERVATIONS)
    store.upsert(_batch(spark, d), OBSERVATIONS, [F.col("revision").desc()])
    return store.read(OBSERVATIONS).select(*_KEY, "temp_max", "precipitation")


@check(
    "upsert_partial",
    """SELECT city, hotel_name, 'hotel' AS hotel_type, coalesce(stars, 0)+1 AS stars, website_url
       FROM pois UNION ALL
       SELECT city, hotel_name||' Annex', 'hotel', coalesce(stars, 0)+1, 'changed' FROM pois""",
)
def upsert_partial(spark, d):
    """Known rows change type and stars only; renamed rows are new and keep it all."""
    columns = ["city", "hotel_name", "hotel_type", "stars", "website_url"]
    old = c.pois(spark, d).select(*columns)
    changed = (
        old.withColumn("stars", F.coalesce("stars", F.lit(0)) + 1)
        .withColumn("hotel_type", F.lit("hotel"))
        .withColumn("website_url", F.lit("changed"))
    )
    renamed = changed.withColumn("hotel_name", F.concat("hotel_name", F.lit(" Annex")))
    store = _store(spark)
    store.append(old, POIS)
    store.upsert_columns(
        changed.unionByName(renamed), POIS, ["hotel_type", "stars"], [F.col("stars").desc()]
    )
    return store.read(POIS).select(*columns)


@check(
    "insert_ignore",
    f"""WITH {_BATCH_SQL} SELECT {_COLS} FROM obs UNION ALL
        SELECT {_COLS} FROM fresh ANTI JOIN obs USING (city, date)""",
)
def insert_ignore(spark, d):
    store = _store(spark)
    store.append(c.obs(spark, d).select(*_KEY, "temp_max", "precipitation"), OBSERVATIONS)
    store.insert_ignore(_batch(spark, d), OBSERVATIONS, [F.col("revision").desc()])
    return store.read(OBSERVATIONS).select(*_KEY, "temp_max", "precipitation")


_RUN_COLS = "run_date, created_at, run_id, model_type, metric_name, metric_value, is_champion"


@check(
    "append_run_log",
    f"""WITH newest AS (SELECT * FROM runs QUALIFY row_number() OVER
          (PARTITION BY model_type, metric_name ORDER BY created_at DESC, run_id DESC) <= 10),
        added AS (SELECT max(run_date)+1 AS run_date, max(created_at)+1 AS created_at,
          max(run_id)+1000000 AS run_id, model_type, metric_name,
          round(avg(metric_value), 3) AS metric_value, FALSE AS is_champion
          FROM newest GROUP BY model_type, metric_name)
        SELECT {_RUN_COLS} FROM runs UNION ALL SELECT {_RUN_COLS} FROM added""",
)
def append_run_log(spark, d):
    """One new run per model type, with the mean metric of the last ten."""
    runs = c.runs(spark, d)
    new = last_runs(runs).groupBy("model_type", "metric_name").agg(
        F.date_add(F.max("run_date"), 1).alias("run_date"),
        F.date_add(F.max("created_at"), 1).alias("created_at"),
        (F.max("run_id") + 1000000).alias("run_id"),
        F.round(F.avg("metric_value"), 3).alias("metric_value"),
        F.lit(False).alias("is_champion"),
    )
    return retrain.log_run(runs, new, [])


# Feature samples of every weekly check, and the drift figures from them, in plain SQL.
_REPLAY = """checks AS (
  SELECT DISTINCT CAST(DATE '1970-01-01' + CAST(ceil((f.feature_date - DATE '1970-01-01')/7.0)*7 + 7*k
    AS INTEGER) AS DATE) AS check_date
  FROM features f CROSS JOIN range(0, 6) t(k)),
long AS (
  SELECT @feature_date, 'temp_mean_3d' AS metric_name, temp_mean_3d AS value FROM features
  UNION ALL SELECT @feature_date, 'precip_sum_3d', precip_sum_3d FROM features
  UNION ALL SELECT @feature_date, 'wind_max_3d', wind_max_3d FROM features),
samples AS (
  SELECT @check_date, metric_name, value, FALSE AS is_current FROM checks JOIN long
    ON feature_date BETWEEN check_date - 35 AND check_date - 7 WHERE value IS NOT NULL
  UNION ALL
  SELECT @check_date, metric_name, value, TRUE FROM checks JOIN long
    ON feature_date BETWEEN check_date - 7 AND check_date WHERE value IS NOT NULL),
sized AS (SELECT *, count(*) FILTER (WHERE NOT is_current) OVER g AS nb,
    count(*) FILTER (WHERE is_current) OVER g AS nc FROM samples
  WHERE check_date <= (SELECT max(feature_date) FROM features)
  WINDOW g AS (PARTITION BY @check_date, metric_name)),
steps AS (SELECT @check_date, metric_name, nb, nc,
    count(*) FILTER (WHERE NOT is_current) OVER v AS cb,
    count(*) FILTER (WHERE is_current) OVER v AS cc FROM sized
  WINDOW v AS (PARTITION BY @check_date, metric_name ORDER BY value
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT @check_date, metric_name,
    max(abs(cb::DOUBLE/nullif(nb, 0) - cc::DOUBLE/nullif(nc, 0))) AS ks_statistic
  FROM steps GROUP BY @check_date, metric_name),
summary AS (SELECT @check_date, metric_name,
    count(*) FILTER (WHERE NOT is_current) AS baseline_n,
    count(*) FILTER (WHERE is_current) AS current_n,
    avg(value) FILTER (WHERE NOT is_current) AS baseline_mean,
    avg(value) FILTER (WHERE is_current) AS current_mean,
    stddev_pop(value) FILTER (WHERE NOT is_current) AS baseline_std
  FROM sized GROUP BY @check_date, metric_name),
drifts AS (SELECT s.*, k.ks_statistic,
    CASE WHEN baseline_std > 0 THEN abs(current_mean-baseline_mean)/baseline_std
         ELSE 0 END AS shift,
    CASE WHEN metric_name LIKE '%temp%' THEN 0.35::DOUBLE WHEN metric_name LIKE '%precip%'
         THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END AS threshold
  FROM summary s JOIN ks k USING (@check_date, metric_name)),
flagged AS (SELECT *, baseline_n > 0 AND current_n > 0
    AND coalesce(ks_statistic > threshold OR shift > 2.5, FALSE) AS drift_detected FROM drifts),
log AS (SELECT *, CASE WHEN NOT drift_detected THEN 'none' WHEN ks_statistic < threshold*1.5 THEN 'minor'
    WHEN ks_statistic < threshold*2 THEN 'major' ELSE 'critical' END AS severity
  FROM flagged WHERE baseline_n > 0 AND current_n > 0)"""
# Over all places together, and for each place on its own.
DRIFT_REPLAY_SQL = _REPLAY.replace("@", "")
DRIFT_BY_PLACE_SQL = _REPLAY.replace("@", "city, ")


def drift_log(spark, d):
    """The drift log that a weekly check over the whole history would have written."""
    found = drift.replay_feature_drift(c.features(spark, d))
    return drift.drift_log_rows(found, F.col("check_date"))


def drift_log_by_place(spark, d):
    """The same with one check per place; the metric is named metric:place."""
    found = drift.replay_feature_drift(c.features(spark, d), by=["city"])
    named = found.withColumn("metric_name", F.concat_ws(":", "metric_name", "city"))
    return drift.drift_log_rows(named, F.col("check_date"))


@check(
    "append_drift_log",
    f"""WITH {DRIFT_REPLAY_SQL} SELECT check_date, 'feature' AS check_type, metric_name,
      round(current_mean + 1e-9, 6) AS metric_value, round(baseline_mean + 1e-9, 6) AS baseline_value,
      round(ks_statistic + 1e-9, 6) AS drift_score, drift_detected, threshold AS threshold_used,
      severity AS drift_severity, baseline_n AS baseline_samples FROM log""",
)
def append_drift_log(spark, d):
    return drift_log(spark, d).select(
        F.col("check_timestamp").cast("date").alias("check_date"),
        "check_type",
        "metric_name",
        *[c.r6(x).alias(x) for x in ("metric_value", "baseline_value", "drift_score")],
        "drift_detected",
        "threshold_used",
        "drift_severity",
        F.get_json_object("metadata", "$.baseline_samples").cast("long").alias("baseline_samples"),
    )


@check(
    "conditional_update",
    f"""SELECT {_RUN_COLS.replace('is_champion', '')}
        is_champion AND model_type <> 'kmeans' AS is_champion FROM runs""",
)
def conditional_update(spark, d):
    store = _store(spark)
    store.append(c.runs(spark, d), MODEL_RUNS)
    flagged = (F.col("model_type") == "kmeans") & F.col("is_champion")
    store.update_where(MODEL_RUNS, flagged, {"is_champion": F.lit(False)})
    names = c.runs(spark, d).columns
    return store.read(MODEL_RUNS).withColumn("created_at", F.col("created_at").cast("date")).select(*names)


@check(
    "retention_delete",
    """SELECT recommendation_date, city, profile_name, cluster_id, comfort_score_pred, rank
       FROM recs_all WHERE recommendation_date >= (SELECT d FROM job_date) - 7""",
)
def retention_delete(spark, d):
    store, recs = _store(spark), c.recs_all(spark, d)
    store.append(recs, RECOMMENDATIONS)
    store.drop_before(RECOMMENDATIONS, c.as_of(spark, d) - timedelta(days=7))
    return store.read(RECOMMENDATIONS).select(*recs.columns)


@check(
    "cascade_delete",
    "SELECT city, feature_date, profile_name, comfort_score FROM scores WHERE profile_name <> 'stargazer'",
)
def cascade_delete(spark, d):
    store, scores = _store(spark), c.scores(spark, d)
    with store.transaction() as t:
        t.append(profiles_table(spark, c.PROFILES), PROFILES)
        t.append(scores, PROFILE_SCORES)
    with store.transaction() as t:
        t.delete_where(PROFILES, F.col("profile_name") == "stargazer")
        t.delete_orphans(PROFILE_SCORES, t.read(PROFILES), ["profile_name"])
    return store.read(PROFILE_SCORES).select(*scores.columns)


@check("model_save_load")
def model_save_load(spark, d):
    """Predictions of a model before and after saving agree on every row; its card says what
    it is."""
    rows = complete(c.features(spark, d), CLUSTER_FEATURES)
    fit = fit_clusters(rows, 4)
    registry = ModelRegistry(spark, scratch_dir(spark, "models"))
    registry.save(fit.model, retrain.cluster_card(fit, 1, str(c.as_of(spark, d))))
    registry.promote("kmeans", 1)
    saved = registry.load("kmeans", CLUSTER_FEATURES)
    before = assign_clusters(fit.model, rows).withColumnRenamed("cluster_id", "before")
    again = assign_clusters(saved.model, before)
    card = saved.card
    return again.groupBy("cluster_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("cluster_id") == F.col("before")).alias("n_equal"),
    ).select(
        "*",
        F.lit(card.k).alias("k"),
        F.lit(", ".join(card.feature_names)).alias("feature_names"),
        F.lit(card.trained_at).alias("trained_at"),
        F.lit(card.metrics["silhouette_score"]).alias("silhouette_score"),
        F.lit(card.metrics["n_samples"]).alias("n_samples"),
    )


@check(
    "cluster_breakdown_text",
    """WITH st AS (SELECT cluster_id, count(*) AS size, round(avg(temp_mean_7d), 1) t,
         round(avg(precip_sum_7d), 1) p, round(avg(wind_max_7d), 1) w FROM clustered GROUP BY 1)
       SELECT string_agg('cluster_'||cluster_id||': size='||size||', temp='||printf('%.1f', t)
         ||'°C, precip='||printf('%.1f', p)||'mm, wind='||printf('%.1f', w)||' km/h',
         chr(10) ORDER BY cluster_id) AS breakdown FROM st""",
)
def cluster_breakdown_text(spark, d):
    return cluster_breakdown(cluster_stats(c.clustered(spark, d), digits=1))


@check(
    "evolve_add_column",
    """SELECT feature_date AS recommendation_date, city, comfort_score AS comfort_score_pred,
         'leisure' AS profile_name FROM features""",
)
def evolve_add_column(spark, d):
    """Recommendations from before there were profiles get the default one; their files
    stay as they are."""
    old = c.features(spark, d).select(
        F.col("feature_date").alias("recommendation_date"),
        "city",
        F.col("comfort_score").alias("comfort_score_pred"),
    )
    store, names = _store(spark), [n for n in RECOMMENDATIONS.columns if n != "profile_name"]
    schema = StructType([RECOMMENDATIONS.schema[n] for n in names])
    before = replace(RECOMMENDATIONS, schema=schema, key=("recommendation_date", "city"))
    store.append(old, before)
    store.add_column(RECOMMENDATIONS, "profile_name", "string", "leisure")
    return store.read(RECOMMENDATIONS).select(*old.columns, "profile_name")


@check(
    "key_uniqueness_check",
    """SELECT city, date, count(*) AS n_rows FROM
         (SELECT city, date FROM obs UNION ALL SELECT city, date+3 FROM obs)
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def key_uniqueness_check(spark, d):
    """The table joined by a careless append of the same days moved by three."""
    keys = c.obs(spark, d).select(*_KEY)
    return writes.duplicate_keys(
        keys.unionByName(keys.withColumn("date", F.date_add("date", 3))), _KEY
    )


@check(
    "not_null_check",
    """SELECT count(*) FILTER (WHERE city IS NULL) AS city, count(*) FILTER (WHERE date IS NULL) AS date,
         count(*) FILTER (WHERE temp_mean IS NULL) AS temp_mean FROM obs""",
)
def not_null_check(spark, d):
    return writes.null_counts(c.obs(spark, d), ["city", "date", "temp_mean"])


@check(
    "fk_check",
    "SELECT city, feature_date, profile_name, comfort_score FROM scores WHERE profile_name = 'skier'",
)
def fk_check(spark, d):
    """The skier profile is scored but not in the seeded table."""
    return writes.orphans(c.scores(spark, d), profiles_table(spark), ["profile_name"])
