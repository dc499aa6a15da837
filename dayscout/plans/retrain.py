"""Weekly retraining with the champion rule."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.operators.learning import (
    ClusterFit,
    RegressionFit,
    assign_clusters,
    at_once,
    compact,
    compare_models,
    fit_clusters,
    optimal_k,
    predict_clipped,
    train_regression,
)
from dayscout.operators.runlog import beats_champion, current_champion
from dayscout.operators.writes import clear_flag
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES, REGRESSION_TARGET
from dayscout.sources.files import shared_dir
from dayscout.sources.models import ModelCard, ModelRegistry
from dayscout.sources.scans import features_all, features_window

N_CLUSTERS = 4
DAYS_BACK = 90
MIN_ROWS = 100

RUN_SCHEMA = (
    "run_date date, created_at date, run_id long, model_type string, metric_name string,"
    "metric_value double, artifact_path string, is_champion boolean"
)


@dataclass
class Retrained:
    clusters: ClusterFit
    regression: RegressionFit
    new_runs: DataFrame
    log: DataFrame


def newest_rows(features: DataFrame) -> DataFrame:
    newest = features.agg(F.max("feature_date")).scalar()
    return features.where(F.col("feature_date") == newest)


def log_run(runs: DataFrame, new: DataFrame, promoted_types: list[str]) -> DataFrame:
    """The log after a run: old champions of promoted types demoted, new rows appended."""
    demoted = clear_flag(
        runs, "is_champion", F.col("model_type").isin(promoted_types) & F.col("is_champion")
    )
    return demoted.unionByName(new.select(*runs.columns))


def cluster_card(fit: ClusterFit, model_id: int, trained_at: str) -> ModelCard:
    metrics = {"n_samples": fit.n_samples, "inertia": fit.inertia, "silhouette_score": fit.silhouette}
    return ModelCard(
        "kmeans", model_id, "kmeans", tuple(CLUSTER_FEATURES), trained_at, metrics, fit.n_clusters
    )


def regression_card(fit: RegressionFit, model_id: int, trained_at: str) -> ModelCard:
    metrics = fit.metrics | {"feature_importances": dict(fit.importances)}
    return ModelCard("regression", model_id, fit.model_type, tuple(fit.columns), trained_at, metrics)


def retrain(
    features: DataFrame,
    runs: DataFrame,
    as_of: dt.date,
    model_root: str,
    run_id: int,
    days_back: int = DAYS_BACK,
    k: int = N_CLUSTERS,
    folds: int | None = 5,
    partitions: int | None = None,
) -> Retrained:
    """Train both models, compare with the champions, log, and store the models.

    ``partitions`` is that of the fits: 90 days of few places need few.

    Models are saved under their run id with their cards; a promotion publishes a pointer
    and never overwrites a model that is being read.
    """
    spark = features.sparkSession
    window = features_window(features, as_of, days_back).persist()
    try:
        clusters, regression = at_once(
            spark,
            lambda train: train(),
            [
                lambda: fit_clusters(newest_rows(window), k, partitions=partitions),
                lambda: train_regression(
                    window, "gradient_boosting", folds=folds, partitions=partitions
                ),
            ],
        )
    finally:
        window.unpersist()
    # At most one row per model type.
    champions = {
        r["model_type"]: r["metric_value"] for r in current_champion(runs).collect()
    }
    registry, when = ModelRegistry(spark, model_root), str(as_of)
    results = [
        ("silhouette_score", round(clusters.silhouette, 3), clusters.model, cluster_card(clusters, run_id, when)),
        ("test_r2", regression.metrics["test_r2"], regression.model, regression_card(regression, run_id + 1, when)),
    ]
    rows = []
    for i, (metric, value, model, card) in enumerate(results):
        kind = card.kind
        path = registry.save(model, card)
        # Without a figure (labels that are all equal have no R2) a run is logged, not promoted.
        wins = value is not None and beats_champion(kind, value, champions.get(kind))
        if wins:
            registry.promote(kind, card.id)
        rows.append((as_of, as_of, run_id + i, kind, metric, value, path, wins))
    new = spark.createDataFrame(rows, RUN_SCHEMA)
    base = runs
    if "artifact_path" not in runs.columns:
        base = runs.withColumn("artifact_path", F.lit(None).cast("string"))
    log = log_run(base, new, [r[3] for r in rows if r[7]])
    return Retrained(clusters, regression, new, log)


@dataclass
class Trained:
    """What the stand-alone training saved: both cards, the comparison of the regressors, and
    the newest date scored by the saved models."""

    clusters: ModelCard
    regression: ModelCard
    comparison: DataFrame
    newest: DataFrame


def train_models(
    features: DataFrame,
    model_root: str,
    as_of: dt.date,
    model_id: int = 1,
    ks=range(2, 6),
    **kwargs,
) -> Trained:
    """The stand-alone form: clusters of the newest date, k by the elbow; best of three
    regressors over all history. Both are saved with their cards and become champions, whatever was before; what scores the
    newest date is what was saved."""
    spark, rows = features.sparkSession, features_all(features)
    n = rows.limit(MIN_ROWS).count()
    if n < MIN_ROWS:
        raise ValueError(f"need at least {MIN_ROWS} feature rows, found {n}")
    shared_dir(spark)
    # Some fifty fits read these few rows: computed once, in as few partitions as they fill.
    newest = compact(newest_rows(rows), None, "city").checkpoint()
    clusters = fit_clusters(newest, optimal_k(newest, ks))
    table, best = compare_models(rows, **kwargs)
    registry = ModelRegistry(spark, model_root)
    cards = cluster_card(clusters, model_id, str(as_of)), regression_card(best, model_id, str(as_of))
    for model, card in zip((clusters.model, best.model), cards, strict=True):
        registry.save(model, card)
        registry.promote(card.kind, card.id)
    return Trained(*cards, table, score_newest(registry, newest))


def score_newest(registry: ModelRegistry, newest: DataFrame) -> DataFrame:
    """Complete rows with the champions' cluster_id, predicted score and absolute error."""
    names = list(dict.fromkeys([*CLUSTER_FEATURES, *REGRESSION_FEATURES]))
    clusters = registry.load("kmeans", CLUSTER_FEATURES).model
    regression = registry.load("regression", REGRESSION_FEATURES).model
    scored = predict_clipped(regression, assign_clusters(clusters, newest.dropna(subset=names)))
    return scored.withColumn("error", F.abs(F.col("predicted") - F.col(REGRESSION_TARGET)))
