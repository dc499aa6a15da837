"""Learning operators. Seeded fits are not expressible in SQL; their tests check
invariants instead."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check
from dayscout.operators import learning as ml
from dayscout.operators.silhouette import silhouette_by_cluster, silhouette_squared
from dayscout.plans.recommend import complete
from dayscout.plans.retrain import newest_rows
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES
from dayscout.sources.scans import features_all, features_window
from dayscout.sources.files import scratch_dir


def _usable(spark, d):
    return features_all(c.features(spark, d))


def _window(spark, d):
    return features_window(c.features(spark, d), c.as_of(spark, d))


_Z = ", ".join(
    f"round(({x}-(SELECT avg({x}) FROM t))/(SELECT stddev_pop({x}) FROM t) + 1e-9, 6) AS {x}_z"
    for x in CLUSTER_FEATURES
)


@check(
    "standard_scale",
    f"""WITH t AS (SELECT * FROM clustered) SELECT city, feature_date, {_Z} FROM t""",
)
def standard_scale(spark, d):
    rows = complete(c.features(spark, d), CLUSTER_FEATURES).select(
        "city", "feature_date", *CLUSTER_FEATURES
    )
    scaled = ml.standard_scale(rows, CLUSTER_FEATURES)
    return scaled.select(
        "city", "feature_date", *[c.r6(f"{x}_z").alias(f"{x}_z") for x in CLUSTER_FEATURES]
    )


@check("kmeans_fit")
def kmeans_fit(spark, d):
    """Four clusters of all feature rows: size, means, inertia, exact silhouette."""
    rows = complete(c.features(spark, d), CLUSTER_FEATURES)
    fit = ml.fit_clusters(rows, 4)
    sizes = fit.assign(rows).groupBy("cluster_id").agg(
        F.count("*").alias("size"), *[F.round(F.avg(x), 1).alias(x) for x in CLUSTER_FEATURES]
    )
    figures = {"inertia": F.lit(round(fit.inertia, 2)), "silhouette": F.lit(round(fit.silhouette, 3))}
    return sizes.withColumns(figures)


@check(
    "kmeans_assign",
    """SELECT city, feature_date, cluster_id, temp_mean_7d, precip_sum_7d, wind_max_7d FROM
       (SELECT city, feature_date, cluster_id, temp_mean_7d, precip_sum_7d, wind_max_7d FROM clustered)""",
)
def kmeans_assign(spark, d):
    rows = complete(c.features(spark, d), CLUSTER_FEATURES)
    assigned = ml.nearest_centroid(rows, c.CENTROIDS)
    return assigned.select("city", "feature_date", "cluster_id", *CLUSTER_FEATURES)


def _silhouette_sql(points: str) -> str:
    """Exact silhouette per cluster; ``points`` gives id, cluster_id, v DOUBLE[]."""
    return f"""WITH pt AS ({points}),
      size AS (SELECT cluster_id, count(*) n FROM pt GROUP BY 1),
      dist AS (SELECT a.id, a.cluster_id, b.cluster_id AS other, sum(list_distance(a.v, b.v)) t
        FROM pt a CROSS JOIN pt b GROUP BY 1, 2, 3),
      ab AS (SELECT id, d.cluster_id, max(CASE WHEN other = d.cluster_id THEN n END) own,
        max(CASE WHEN other = d.cluster_id AND n > 1 THEN t/(n-1) END) a,
        min(CASE WHEN other <> d.cluster_id THEN t/n END) b
        FROM dist d JOIN size s ON s.cluster_id = d.other GROUP BY 1, 2),
      sc AS (SELECT cluster_id, CASE WHEN own = 1 OR b IS NULL THEN 0 ELSE (b-a)/greatest(a, b) END s FROM ab)
      SELECT cluster_id, round(avg(s) + 1e-9, 6) AS silhouette_score, count(*) AS n_points FROM sc GROUP BY 1"""


@check(
    "silhouette_exact",
    _silhouette_sql("SELECT vec_id AS id, label AS cluster_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"),
)
def silhouette_exact(spark, d):
    """Of the given vectors under their given labels."""
    points = c.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster_id"),
        F.col("embedding").alias("features"),
    )
    found = silhouette_by_cluster(points)
    return found.withColumn("silhouette_score", c.r6("silhouette_score"))


@check(
    "silhouette_newest_date",
    _silhouette_sql(
        f"""SELECT city AS id, CAST({c._centroid_sql()} AS INTEGER) AS cluster_id,
            [temp_mean_7d, precip_sum_7d, wind_max_7d] AS v FROM daily_features
            WHERE temp_mean_7d IS NOT NULL AND precip_sum_7d IS NOT NULL"""
    ),
)
def silhouette_newest_date(spark, d):
    rows = c.assign(complete(c.daily_features(spark, d), CLUSTER_FEATURES))
    points = rows.select(
        F.col("city").alias("id"), "cluster_id", F.array(*CLUSTER_FEATURES).alias("features")
    )
    found = silhouette_by_cluster(points)
    return found.withColumn("silhouette_score", c.r6("silhouette_score"))


@check("silhouette_scalable")
def silhouette_scalable(spark, d):
    rows = complete(c.features(spark, d), CLUSTER_FEATURES)
    fit = ml.fit_clusters(rows, 4, with_silhouette=False)
    assigned = ml.assign_clusters(fit.model, rows, keep_vector=True)
    value = silhouette_squared(assigned)
    return assigned.agg(F.count("*").alias("n_rows")).withColumn("silhouette", F.lit(value))


@check("optimal_k")
def optimal_k(spark, d):
    """Inertia and silhouette per k on the newest date, with the elbow."""
    rows = c.daily_features(spark, d)
    curve = ml.scan_k(rows, range(2, 7), partitions=FEW)
    best = ml.elbow(curve).select("elbow_k")
    return curve.withColumn("elbow_k", best.scalar())


@check(
    "train_test_split",
    """WITH h AS (SELECT city, feature_date, md5(city||'|'||feature_date||'|42') AS h FROM features
         WHERE temp_mean_7d IS NOT NULL AND temp_mean_3d IS NOT NULL),
       r AS (SELECT *, row_number() OVER (ORDER BY h) AS n, count(*) OVER () AS total FROM h)
       SELECT city, feature_date, n <= ceil(total*0.2) AS is_test FROM r""",
)
def train_test_split(spark, d):
    rows = _usable(spark, d).select("city", "feature_date")
    return ml.train_test_split(rows, ["city", "feature_date"])


def _metrics_frame(spark, metrics):
    """One row per figure; one that the rows do not define (R2 of equal labels) is NULL."""
    numbers = {k: v for k, v in metrics.items() if not isinstance(v, str)}
    rows = [(k, None if v is None else float(v)) for k, v in numbers.items()]
    return spark.createDataFrame(rows, "metric string, value double").orderBy("metric")


def _single_fit(key, model_type, *sql):
    def fn(spark, d):
        return _metrics_frame(spark, ml.train_regression(_usable(spark, d), model_type).metrics)

    fn.__name__ = key
    return check(key, *sql)(fn)


# Ridge by its normal equations: moments per fold, their sums less one fold for a fold's
# model, and three by three equations by Cramer's rule.
_XS = ("x1", "x2", "x3")
_PAIRS = [(i, j) for i in range(3) for j in range(i, 3)]


def _m(i: int, j: int) -> str:
    return f"m{min(i, j)}{max(i, j)}"


def _det(m: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a}*({e}*{i}-{f}*{h}) - {b}*({d}*{i}-{f}*{g}) + {c}*({d}*{h}-{e}*{g}))"


def _solved(k: int) -> str:
    """The weight of feature k."""
    left = [[_m(i, j) + ("+penalty" if i == j else "") for j in range(3)] for i in range(3)]
    left = [[f"({x})" for x in row] for row in left]
    top = [[f"c{i}" if j == k else left[i][j] for j in range(3)] for i in range(3)]
    return f"{_det(top)} / {_det(left)}"


_PREDICTED = "b0 + " + " + ".join(f"w{i}*{x}" for i, x in enumerate(_XS))
_SCORES = (
    "sqrt(avg((p-y)*(p-y))) AS rmse, avg(abs(p-y)) AS mae, 1 - sum((p-y)*(p-y)) / (var_pop(y)*count(*)) AS r2, count(*) AS n"
)
_RIDGE_SQL = f"""WITH raw AS (
    SELECT city, feature_date, temp_mean_3d AS r1, precip_sum_3d AS r2, wind_max_3d AS r3, comfort_score AS y,
      md5(city||'|'||feature_date||'|42') AS h,
      CAST('0x'||substr(md5(city||'|'||feature_date||'|43'), 1, 7) AS BIGINT) % 5 AS fold
    FROM features WHERE temp_mean_7d IS NOT NULL AND temp_mean_3d IS NOT NULL AND precip_sum_3d IS NOT NULL
      AND wind_max_3d IS NOT NULL AND comfort_score IS NOT NULL),
  parted AS (SELECT *, row_number() OVER (ORDER BY h) <= ceil(count(*) OVER () * 0.2) AS is_test FROM raw),
  scale AS (SELECT {", ".join(f"avg(r{i}) AS a{i}, stddev_pop(r{i}) AS s{i}" for i in (1, 2, 3))},
    stddev_pop(y) AS sy, count(*) AS n FROM parted WHERE NOT is_test),
  z AS (SELECT is_test, fold, y, {", ".join(f"(r{i}-a{i})/s{i} AS x{i}" for i in (1, 2, 3))} FROM parted, scale),
  models AS (SELECT k FROM range(-1, 5) t(k)),
  moments AS (SELECT k, avg(y) AS my, stddev_pop(y) AS sd, {", ".join(f"avg({x}) AS u{i}" for i, x in enumerate(_XS))},
      {", ".join(f"covar_pop({_XS[i]}, {_XS[j]}) AS m{i}{j}" for i, j in _PAIRS)},
      {", ".join(f"covar_pop({x}, y) AS c{i}" for i, x in enumerate(_XS))}
    FROM models JOIN z ON NOT is_test AND fold <> k GROUP BY k),
  posed AS (SELECT m.*, s.sy / s.n / m.sd AS penalty FROM moments m, scale s),
  solved AS (SELECT k, my, u0, u1, u2, {", ".join(f"{_solved(i)} AS w{i}" for i in range(3))} FROM posed),
  fits AS (SELECT k, w0, w1, w2, my - w0*u0 - w1*u1 - w2*u2 AS b0 FROM solved),
  whole AS (SELECT is_test, {_SCORES} FROM (SELECT is_test, y, {_PREDICTED} AS p FROM z JOIN fits ON k = -1) GROUP BY 1),
  folds AS (SELECT r2 FROM (SELECT k, {_SCORES} FROM (SELECT k, y, {_PREDICTED} AS p FROM z JOIN fits
      ON k = fold AND NOT is_test) GROUP BY 1)),
  named AS (SELECT CASE WHEN is_test THEN 'test_' ELSE 'train_' END AS part, * FROM whole)
  SELECT part||'rmse' AS metric, round(rmse, 2) AS value FROM named
  UNION ALL SELECT part||'mae', round(mae, 2) FROM named UNION ALL SELECT part||'r2', round(r2, 3) FROM named
  UNION ALL SELECT 'n_'||rtrim(part, '_'), CAST(n AS DOUBLE) FROM named
  UNION ALL SELECT 'n_samples', CAST(sum(n) AS DOUBLE) FROM named
  UNION ALL SELECT 'cv_r2_mean', round(avg(r2), 3) FROM folds
  UNION ALL SELECT 'cv_r2_std', round(stddev_pop(r2), 3) FROM folds"""

_single_fit("ridge_fit", "ridge", _RIDGE_SQL)
_single_fit("random_forest_fit", "random_forest")
_single_fit("gbt_fit", "gradient_boosting")


@check("train_eval")
def train_eval(spark, d):
    """The retraining form: last 90 days, boosting, metrics of both parts and folds."""
    return _metrics_frame(spark, ml.train_regression(_window(spark, d), partitions=FEW).metrics)


@check("cross_validate_r2")
def cross_validate_r2(spark, d):
    """Of the boosted model over all history: every fold. (No figure of the folds depends on
    the model of the whole training part.)"""
    fit = ml.train_regression(_usable(spark, d), final=False)
    wanted = {k: v for k, v in fit.metrics.items() if k.startswith("cv_")}
    return _metrics_frame(spark, wanted)


@check("feature_importances")
def feature_importances(spark, d):
    """Of the boosted model over all history. (No importance depends on the folds.)"""
    fit = ml.train_regression(_usable(spark, d), folds=None)
    return spark.createDataFrame(fit.importances, "feature string, importance double")


#: partitions of the fits over 90 days of 25 places
FEW = 2


def champions(spark, d):
    """The cluster and regression models, trained as the weekly job would, stored in the
    shared folder and loaded from there, as the jobs that serve them do. (Folds and the
    silhouette are figures of the training job; no served model depends on them.)"""
    rows = _window(spark, d).persist()
    try:
        clusters, fit = ml.at_once(
            spark,
            lambda train: train(),
            [
                lambda: ml.fit_clusters(newest_rows(rows), 4, with_silhouette=False, partitions=FEW),
                lambda: ml.train_regression(rows, folds=None, partitions=FEW),
            ],
        )
    finally:
        rows.unpersist()
    root = scratch_dir(spark, "champions")
    ml.save_model(clusters.model, f"{root}/kmeans")
    ml.save_model(fit.model, f"{root}/regression")
    return ml.load_model(f"{root}/kmeans"), ml.load_model(f"{root}/regression")


@check("rank_feature_importance")
def rank_feature_importance(spark, d):
    _, regression = champions(spark, d)
    ranked = ml.feature_importances(regression, REGRESSION_FEATURES)
    rows = spark.createDataFrame(ranked, "feature string, importance double")
    return rows.orderBy(F.col("importance").desc(), "feature")


@check("compare_models")
def compare_models(spark, d):
    """All three models over all history, each with its folds."""
    return ml.compare_models(_usable(spark, d))[0]


@check("order_model_comparison")
def order_model_comparison(spark, d):
    """The best model only, first of all by test R2. (Its row has no figure of the folds of
    another model.)"""
    return ml.compare_models(_usable(spark, d), best_only=True)[0]


@check("predict_clipped")
def predict_clipped(spark, d):
    """All history, by the model that is served."""
    _, regression = champions(spark, d)
    rows = complete(_usable(spark, d), REGRESSION_FEATURES)
    scored = ml.predict_clipped(regression, rows)
    return scored.select("city", "feature_date", F.round("predicted", 4).alias("predicted"))


@check("score_newest_date")
def score_newest_date(spark, d):
    """Both models on the newest date: five best, each with its error."""
    clusters, regression = champions(spark, d)
    today = complete(
        newest_rows(_window(spark, d)), [*CLUSTER_FEATURES, *REGRESSION_FEATURES]
    )
    scored = ml.predict_clipped(regression, ml.assign_clusters(clusters, today))
    error = F.abs(F.col("predicted") - F.col("comfort_score"))
    overall = scored.agg(F.struct(F.avg(error).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")))
    e = overall.scalar()
    return (
        scored.select("city", "cluster_id", "predicted", "comfort_score", error.alias("error"))
        .orderBy(F.col("predicted").desc(), "city")
        .limit(5)
        .withColumn("mae", e["mae"])
        .withColumn("rmse", e["rmse"])
    )


