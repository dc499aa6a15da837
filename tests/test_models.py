"""Saved models with their cards, champions, and the stand-alone training."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from dayscout.plans import retrain
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES
from dayscout.sources.files import Files
from dayscout.sources.models import FeatureMismatchError, ModelCard, ModelRegistry

DAY = dt.date(2024, 3, 1)


@pytest.fixture(scope="module")
def pipeline(spark):
    rows = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    return Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(rows)


@pytest.fixture
def registry(spark, tmp_path):
    return ModelRegistry(spark, str(tmp_path / "models"))


CARD = ModelCard("regression", 7, "ridge", ("a", "b"), "2024-03-01", {"test_r2": 0.5, "n": 3})


def test_a_card_comes_back_with_its_model(spark, registry, pipeline):
    registry.save(pipeline, CARD)
    saved = registry.load("regression", ["a", "b"], 7)
    assert saved.card == CARD
    rows = spark.createDataFrame([(3.0, 4.0)], "a double, b double")
    assert saved.model.transform(rows).first()["v"].tolist() == [3.0, 4.0]


def test_other_features_are_refused(registry, pipeline):
    registry.save(pipeline, CARD)
    for names in (["b", "a"], ["a"], ["a", "b", "c"]):
        with pytest.raises(FeatureMismatchError, match="trained on a, b"):
            registry.load("regression", names, 7)


def test_the_newest_pointer_names_the_champion(registry, pipeline):
    with pytest.raises(ValueError, match="no champion"):
        registry.load("regression")
    registry.save(pipeline, CARD)
    registry.save(pipeline, replace(CARD, id=9))
    assert registry.champion("regression") is None
    for model in (7, 9, 7):
        registry.promote("regression", model)
        assert registry.champion("regression") == model == registry.load("regression").card.id
    assert [c.id for c in registry.cards("regression")] == [7, 9]


def test_models_are_never_replaced_and_half_saved_ones_are_not_there(spark, registry, pipeline, monkeypatch):
    registry.save(pipeline, CARD)
    with pytest.raises(ValueError, match="saved already"):
        registry.save(pipeline, CARD)

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(Files, "publish", lost)
    with pytest.raises(KeyboardInterrupt):
        registry.save(pipeline, replace(CARD, id=8))
    monkeypatch.undo()
    assert [c.id for c in registry.cards("regression")] == [7]
    with pytest.raises(Exception):
        registry.promote("regression", 8)
    registry.save(pipeline, replace(CARD, id=8))  # the job runs again
    assert PipelineModel.load(registry.path("regression", 8)) is not None


def test_of_two_promotions_at_once_one_is_told(registry, pipeline, monkeypatch):
    registry.save(pipeline, CARD)
    seen = registry._pointers("regression")
    registry.promote("regression", 7)
    monkeypatch.setattr(registry, "_pointers", lambda kind: seen)
    with pytest.raises(RuntimeError, match="promoted meanwhile"):
        registry.promote("regression", 7)


def test_stand_alone_training_saves_what_it_scores(spark, tmp_path):
    wave = lambda k: (F.sin(F.col("id") * k) + 1) * 20
    rows = spark.range(240).select(
        F.concat(F.lit("c"), (F.col("id") % 24).cast("string")).alias("city"),
        F.date_add(F.lit(DAY), (F.col("id") / 24).cast("int")).alias("feature_date"),
        *[wave(i + 0.3).alias(c) for i, c in enumerate([*CLUSTER_FEATURES, *REGRESSION_FEATURES])],
    ).withColumn("comfort_score", F.least(F.lit(100.0), F.col(REGRESSION_FEATURES[0]) + F.col(REGRESSION_FEATURES[1])))
    trained = retrain.train_models(rows, str(tmp_path), DAY, model_types=["ridge"], folds=2, partitions=2)
    registry = ModelRegistry(spark, str(tmp_path))
    assert registry.load("kmeans", CLUSTER_FEATURES).card == trained.clusters
    assert registry.load("regression", REGRESSION_FEATURES).card == trained.regression
    assert trained.regression.model_type == "ridge" and "cv_r2_mean" in trained.regression.metrics
    assert trained.clusters.k in range(2, 6) and trained.clusters.metrics["silhouette_score"] is not None
    assert trained.comparison.count() == 1
    newest = trained.newest.collect()
    assert len(newest) == 24 and len({r["feature_date"] for r in newest}) == 1
    assert all(r["error"] == pytest.approx(abs(r["predicted"] - r["comfort_score"])) for r in newest)
