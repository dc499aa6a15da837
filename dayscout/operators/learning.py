"""Scaling, clustering and regression with MLlib; keys stay next to their vectors."""

from __future__ import annotations

import math
import statistics
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayscout.functions.scoring import clip_score
from dayscout.operators.aggregates import regression_metrics
from dayscout.operators.silhouette import as_points, silhouette_exact
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES, REGRESSION_TARGET
from dayscout.sources.store import shared_dir

SEED = 42
RESTARTS = 10
TEST_SIZE = 0.2
FOLDS = 5
KMEANS_ITERATIONS = 300
TREE_BINS = 256
#: histograms a task holds at once. More nodes than fit are split in further passes, to the
#: same trees; several tasks and fits share an executor
TREE_MEMORY_MB = 128
#: trees after which boosting stores its residuals. A task carries the plan of all trees
#: since then, so a long way costs more than the file of a short one
BOOSTING_CHECKPOINT = 3
#: models whose folds wait until it is known that a result shows them. A forest's fit fills a
#: core; the others' are short jobs that overlap almost freely with the final fits
FOLDS_LATE = {"random_forest"}


def at_once(spark: SparkSession, fn: Callable, items: Iterable, width: int = 10) -> list:
    """``fn`` on every item, as concurrent Spark jobs. Fits on small frames are bound by
    the latency of their many short jobs, so independent fits overlap almost freely."""
    items = list(items)
    with ThreadPool(max(1, min(width, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(fn), items, chunksize=1)


def dealt(rows: DataFrame, partitions: int | None, *key: str) -> DataFrame:
    """``rows`` in as many partitions as the caller asks for, by hash of ``key`` (the same
    rows in the same ones each time); as they are without a number. An iterative fit pays
    per task, so the caller of a small frame may ask for few."""
    return rows if partitions is None else rows.repartition(partitions, *key)


def compact(rows: DataFrame, partitions: int | None, *key: str) -> DataFrame:
    """``rows`` dealt by ``key`` into as many partitions as their bytes fill, which Spark finds
    out while it runs, or into as many as the caller asks for. Every partition of a tree
    fit sends a histogram per node, so partitions that hold little cost the most.
    Checkpoint the result: a persisted plan keeps all of its shuffle's partitions."""
    return rows.hint("rebalance", *key) if partitions is None else dealt(rows, partitions, *key)


# --- scaling -----------------------------------------------------------------


def standard_scale(rows: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """z-scores with the population deviation; a constant column scales to 0."""
    stats = rows.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
        )
    ).scalar()
    out = [
        F.when(stats[f"{c}_s"] > 0, (F.col(c) - stats[f"{c}_m"]) / stats[f"{c}_s"])
        .otherwise(F.col(c) - stats[f"{c}_m"])
        .alias(f"{c}{suffix}")
        for c in columns
    ]
    return rows.select("*", *out)


def scaler_stages(columns: Sequence[str], n_rows: int) -> list:
    """Assembler and scaler. MLlib divides by the sample deviation; the last stage
    turns that into the population deviation, so distances and inertia agree."""
    factor = math.sqrt(n_rows / (n_rows - 1)) if n_rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_vector"),
        StandardScaler(inputCol="raw_vector", outputCol="sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="sample_scaled",
            outputCol="scaled",
            scalingVec=Vectors.dense([factor] * len(columns)),
        ),
    ]


# --- assignment to literal centroids ------------------------------------------


def squared_distance(columns: Sequence[str], centre: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, x in zip(columns, centre, strict=True):
        d = F.col(c) - F.lit(float(x))
        total = total + d * d
    return total


def nearest_centroid(
    rows: DataFrame, centroids: Sequence[Sequence[float]], columns: Sequence[str] = tuple(CLUSTER_FEATURES)
) -> DataFrame:
    """Adds ``cluster_id``, the index of the nearest centroid (lowest index on ties)."""
    candidates = F.array(
        *[
            F.struct(squared_distance(columns, c).alias("d"), F.lit(i).alias("i"))
            for i, c in enumerate(centroids)
        ]
    )
    return rows.withColumn("cluster_id", F.array_min(candidates)["i"])


# --- clustering ----------------------------------------------------------------


@dataclass
class ClusterFit:
    """A fitted clustering pipeline with its training figures."""

    model: PipelineModel
    n_clusters: int
    n_samples: int
    inertia: float
    silhouette: float | None = None

    def assign(self, rows: DataFrame) -> DataFrame:
        return assign_clusters(self.model, rows)


def assign_clusters(model: PipelineModel, rows: DataFrame, keep_vector: bool = False) -> DataFrame:
    """Rows with ``cluster_id``; keys and all other columns stay."""
    kept = [*rows.columns, "cluster_id"] + (["scaled"] if keep_vector else [])
    return model.transform(rows).select(*kept)


def fit_clusters(
    rows: DataFrame,
    k: int = 4,
    columns: Sequence[str] = tuple(CLUSTER_FEATURES),
    seed: int = SEED,
    restarts: int = RESTARTS,
    with_silhouette: bool = True,
    max_iterations: int = KMEANS_ITERATIONS,
    partitions: int | None = None,
) -> ClusterFit:
    """k-means on z-scores; of several seeded restarts the lowest inertia wins. Every
    complete row is a point, whatever its key."""
    clean = dealt(rows.select(*columns).dropna(), partitions, *columns).persist()
    try:
        return _fit_clusters(clean, k, columns, seed, restarts, with_silhouette, max_iterations)
    finally:
        clean.unpersist()


def _fit_clusters(
    clean: DataFrame,
    k: int,
    columns: Sequence[str],
    seed: int,
    restarts: int,
    with_silhouette: bool,
    max_iterations: int,
) -> ClusterFit:
    n = clean.count()
    if n == 0:
        raise ValueError("no complete rows to cluster")
    scaler = Pipeline(stages=scaler_stages(columns, n)).fit(clean)
    scaled = scaler.transform(clean).select("scaled").persist()
    try:
        def restart(i: int):
            return KMeans(
                k=k, seed=seed + i, featuresCol="scaled", predictionCol="cluster_id",
                maxIter=max_iterations,
            ).fit(scaled)

        fits = at_once(clean.sparkSession, restart, range(restarts))
        best = min(fits, key=lambda m: m.summary.trainingCost)
        fit = ClusterFit(
            PipelineModel([*scaler.stages, best]), k, n, float(best.summary.trainingCost)
        )
        if with_silhouette:
            row = silhouette_exact(as_points(best.transform(scaled)), n_points=n).first()
            fit.silhouette = float(row["silhouette_score"])
    finally:
        scaled.unpersist()
    return fit


def inertia_for_centroids(
    rows: DataFrame,
    centroids: Sequence[Sequence[float]],
    ks: Sequence[int],
    columns: Sequence[str] = tuple(CLUSTER_FEATURES),
) -> DataFrame:
    """(k, inertia) with the first k of the given centroids, for several k in one pass."""
    clean = rows.dropna(subset=list(columns))
    distances = [squared_distance(columns, c) for c in centroids]
    def nearest(k: int) -> Column:
        return F.least(*distances[:k]) if k > 1 else distances[0]

    return clean.agg(
        F.array(
            *[F.struct(F.lit(k).alias("k"), F.sum(nearest(k)).alias("inertia")) for k in ks]
        ).alias("t")
    ).select(F.inline("t"))


def elbow(inertias: DataFrame, offset: int = 2) -> DataFrame:
    """The k at the largest second difference of the inertia (first on ties).

    ``offset`` is added to the position of the difference: 2 reproduces the customary
    result of this job, 1 is the textbook elbow. One row per k comes in.
    """
    w = Window.orderBy("k")
    bend = F.lead("inertia", 2).over(w) - 2 * F.lead("inertia", 1).over(w) + F.col("inertia")
    bent = inertias.select(
        "k", bend.alias("second_difference"), F.lead("k", offset).over(w).alias("elbow_k")
    )
    first = F.max_by("elbow_k", F.struct("second_difference", -F.col("k")))
    return bent.where(F.col("second_difference").isNotNull()).agg(
        first.alias("elbow_k"), F.max("second_difference").alias("second_difference")
    )


def scan_k(rows: DataFrame, ks: Sequence[int] = range(2, 7), **kwargs) -> DataFrame:
    """(k, inertia, silhouette) for each k."""
    spark = rows.sparkSession
    fits = at_once(spark, lambda k: fit_clusters(rows, k, **kwargs), ks, width=3)
    return spark.createDataFrame(
        [(f.n_clusters, f.inertia, f.silhouette) for f in fits],
        "k int, inertia double, silhouette double",
    )


def optimal_k(rows: DataFrame, ks: Sequence[int] = range(2, 7), offset: int = 2, **kwargs) -> int:
    """Elbow of the inertia; with fewer than three values, the best silhouette."""
    table = scan_k(rows, ks, **kwargs)
    if len(list(ks)) >= 3:
        return int(elbow(table, offset).first()["elbow_k"])
    return int(table.orderBy(F.col("silhouette").desc(), "k").first()["k"])


# --- splits --------------------------------------------------------------------


def row_hash(key: Sequence[str], seed: int = SEED) -> Column:
    """A repeatable random order: md5 of the key and the seed, as hex text."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def test_cut(rows: DataFrame, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED):
    """One row with ``cut``: rows whose hash is at most it form a test part of exactly
    ceil(test_size * n) rows.

    Rows are counted per hash prefix (65,536 even buckets); only the rows of the one
    bucket that holds the cut are sorted.
    """
    hashed = rows.select(row_hash(key, seed).alias("h")).withColumn("b", F.substring("h", 1, 4))
    counts = hashed.groupBy("b").agg(F.count("*").alias("n"))
    wanted = F.ceil(F.sum("n").over(Window.partitionBy()) * test_size)
    through = F.sum("n").over(Window.orderBy("b"))
    bucket = (
        counts.select("b", "n", wanted.alias("wanted"), through.alias("through"))
        .where((F.col("through") >= F.col("wanted")) & (F.col("through") - F.col("n") < F.col("wanted")))
        .select("b", (F.col("wanted") - F.col("through") + F.col("n")).alias("need"))
    )
    return (
        hashed.join(bucket, "b")
        .withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("h")))
        .where(F.col("r") == F.col("need"))
        .agg(F.max("h").alias("cut"))
    )


def train_test_split(
    rows: DataFrame, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``; the same rows whatever the partitioning."""
    cut = test_cut(rows, key, test_size, seed).scalar()
    return rows.withColumn("is_test", row_hash(key, seed) <= cut)


def fold_of(key: Sequence[str], folds: int = FOLDS, seed: int = SEED) -> Column:
    """Fold number 0..folds-1 from the hash of the key."""
    number = F.conv(F.substring(row_hash(key, seed + 1), 1, 7), 16, 10).cast("int")
    return F.pmod(number, F.lit(folds)).cast("int")


# --- regression ------------------------------------------------------------------

# The model types by the names they are logged with.
MODEL_TYPES = ["ridge", "random_forest", "gradient_boosting"]


def make_regressor(
    model_type: str, n_rows: int, target_std: float, seed: int = SEED, max_bins: int = TREE_BINS
):
    """The estimator of a model type, on column ``scaled``.

    Ridge: MLlib averages the loss over the rows and standardises the target, so a
    penalty of alpha becomes ``alpha * std / n``.
    """
    common = {"featuresCol": "scaled", "labelCol": "label", "predictionCol": "prediction"}
    if model_type == "ridge":
        alpha = 1.0
        return LinearRegression(
            **common, elasticNetParam=0.0, regParam=alpha * target_std / n_rows,
            standardization=False, solver="normal",
        )
    # min_samples_split = 5 has no counterpart; two rows per child is the nearest.
    if model_type == "random_forest":
        return RandomForestRegressor(
            **common, numTrees=100, maxDepth=10, minInstancesPerNode=2,
            featureSubsetStrategy="all", seed=seed, maxBins=max_bins, maxMemoryInMB=TREE_MEMORY_MB,
        )
    if model_type == "gradient_boosting":
        return GBTRegressor(
            **common, maxIter=100, stepSize=0.1, maxDepth=5, minInstancesPerNode=2, seed=seed,
            maxBins=max_bins, maxMemoryInMB=TREE_MEMORY_MB, checkpointInterval=BOOSTING_CHECKPOINT,
        )
    raise ValueError(f"unknown model type: {model_type}")


@dataclass
class RegressionFit:
    """A fitted regression pipeline with its metrics; no pipeline where only folds were fitted."""

    model: PipelineModel | None
    model_type: str
    columns: list[str]
    metrics: dict = field(default_factory=dict)

    def predict(self, rows: DataFrame) -> DataFrame:
        return predict_clipped(self.model, rows)

    @property
    def importances(self) -> list[tuple[str, float]]:
        return feature_importances(self.model, self.columns)


def predict_clipped(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with ``predicted``: scaled, predicted, clipped to 0..100."""
    out = model.transform(rows)
    return out.select(*rows.columns, clip_score(F.col("prediction")).alias("predicted"))


def feature_importances(model: PipelineModel, columns: Sequence[str]) -> list[tuple[str, float]]:
    """Named importances, highest first; empty for a linear model."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return []
    values = last.featureImportances.toArray().tolist()
    return sorted(zip(columns, values, strict=True), key=lambda x: (-x[1], x[0]))


def cv_figures(r2: Sequence[float | None]) -> dict[str, float | None]:
    """Mean and deviation over the folds that have an R2. One whose labels are all equal, or
    that is empty, has none; without any, both figures are None."""
    known = [x for x in r2 if x is not None]
    return {
        "cv_r2_mean": round(statistics.fmean(known), 3) if known else None,
        "cv_r2_std": round(statistics.pstdev(known), 3) if known else None,
    }


@dataclass
class Prepared:
    """Rows of a regression as its fits need them: read, split and scaled once for any number
    of models."""

    parts: DataFrame  # cached: key, features, label, is_test, fold
    scaled: DataFrame  # stored: the training part
    scaler: PipelineModel
    n_train: int
    n_test: int
    label_std: float


@contextmanager
def prepared(
    rows: DataFrame,
    columns: Sequence[str] = tuple(REGRESSION_FEATURES),
    target: str = REGRESSION_TARGET,
    key: Sequence[str] = ("city", "feature_date"),
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    folds: int | None = FOLDS,
    partitions: int | None = None,
) -> Iterator[Prepared]:
    """Split the rows, scale on the training part; the input is read once."""
    shared_dir(rows.sparkSession)
    clean = compact(
        rows.select(*key, *columns, F.col(target).alias("label")).dropna(), partitions, *key
    ).checkpoint()
    parts = train_test_split(clean, key, test_size, seed).withColumn(
        "fold", fold_of(key, folds or FOLDS, seed)
    ).persist()
    try:
        facts = parts.groupBy("is_test").agg(
            F.count("*").alias("n"), F.stddev_pop("label").alias("std")
        ).collect()
        sizes = {r["is_test"]: r for r in facts}
        if True not in sizes or False not in sizes:
            raise ValueError("too few rows to split")
        n_train = sizes[False]["n"]
        train = parts.where(~F.col("is_test"))
        scaler = Pipeline(stages=scaler_stages(columns, n_train)).fit(train)
        # Stored once and not cached: a fit's tasks follow what is cached, so all fits of a
        # small frame would share the one executor that has it, and each task would carry
        # the plan behind it. The fits cache their own rows, wherever they begin.
        scaled = scaler.transform(train).select("scaled", "label", "fold").checkpoint()
        yield Prepared(parts, scaled, scaler, n_train, sizes[True]["n"], sizes[False]["std"])
    finally:
        parts.unpersist()


def train_regression(
    rows: DataFrame,
    model_type: str = "gradient_boosting",
    columns: Sequence[str] = tuple(REGRESSION_FEATURES),
    target: str = REGRESSION_TARGET,
    key: Sequence[str] = ("city", "feature_date"),
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    folds: int | None = FOLDS,
    max_bins: int = TREE_BINS,
    partitions: int | None = None,
    final: bool = True,
    ready: Prepared | None = None,
) -> RegressionFit:
    """Split, scale on the training part, fit, evaluate, cross validate.

    The input is read once. The fold fits and the final fit do not depend on each other
    and run at once; boosting cuts its lineage in the shared folder. Without ``final`` the
    folds are all there is: a cross validation needs no model of the whole training part.
    ``ready`` are the rows as ``prepared`` gave them for the same options, where several
    models share them.
    """
    if not (folds or final):
        raise ValueError("neither folds nor a final fit are asked for")
    source = nullcontext(ready) if ready else prepared(
        rows, columns, target, key, test_size, seed, folds, partitions
    )
    with source as p:
        return _train_regression(p, model_type, columns, seed, folds, max_bins, final)


def _train_regression(
    p: Prepared,
    model_type: str,
    columns: Sequence[str],
    seed: int,
    folds: int | None,
    max_bins: int,
    final: bool,
) -> RegressionFit:
    scaled = p.scaled
    estimator = make_regressor(model_type, p.n_train, p.label_std, seed, max_bins)

    def fit_fold(fold: int | None):
        """The final model for None, else the R2 on the fold left out."""
        if fold is None:
            return estimator.fit(scaled)
        model = estimator.fit(scaled.where(F.col("fold") != fold))
        out = model.transform(scaled.where(F.col("fold") == fold))
        return regression_metrics(out, "label", "prediction", digits=None).first()["r2"]

    wanted = [*([None] if final else []), *range(folds or 0)]
    fits = at_once(scaled.sparkSession, fit_fold, wanted, width=6)
    cv = cv_figures(fits[1:] if final else fits) if folds else {}
    counts = {"n_samples": p.n_train + p.n_test, "n_train": p.n_train, "n_test": p.n_test}
    if not final:
        return RegressionFit(None, model_type, list(columns), {"model_type": model_type, **counts, **cv})
    model = PipelineModel([*p.scaler.stages, fits[0]])
    # Metrics use the unclipped prediction, as is usual while training.
    scored = model.transform(p.parts).select(
        "is_test", F.col("label").alias("actual"), F.col("prediction").alias("predicted")
    )
    by_part = {r["is_test"]: r for r in regression_metrics(scored, group=["is_test"]).collect()}
    metrics = {
        "model_type": model_type,
        **counts,
        **{
            f"{part}_{m}": by_part[flag][m]
            for part, flag in (("train", False), ("test", True))
            for m in ("rmse", "mae", "r2")
        },
        **cv,
    }
    return RegressionFit(model, model_type, list(columns), metrics)


COMPARISON_SCHEMA = (
    "model string, test_rmse double, test_mae double, test_r2 double, cv_r2 double"
)


def comparison_table(spark, fits: Sequence[RegressionFit]) -> DataFrame:
    """One row per model, best test R2 first."""
    rows = [
        (
            f.model_type,
            f.metrics["test_rmse"],
            f.metrics["test_mae"],
            f.metrics["test_r2"],
            f.metrics.get("cv_r2_mean"),
        )
        for f in fits
    ]
    # as literals: a frame of a Python list would start Python workers for three rows
    fields = [field.split() for field in COMPARISON_SCHEMA.split(", ")]
    literals = [
        F.struct(*[F.lit(x).cast(kind).alias(name) for x, (name, kind) in zip(r, fields, strict=True)])
        for r in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*literals))).orderBy(
        F.col("test_r2").desc(), "test_rmse", "model"
    )


def compare_models(
    rows: DataFrame,
    model_types: Sequence[str] = tuple(MODEL_TYPES),
    best_only: bool = False,
    folds: int | None = FOLDS,
    **kwargs,
) -> tuple[DataFrame, RegressionFit]:
    """Train every model type; returns the comparison and the best fit.

    All models share one read, split and scaling. The best fit is kept rather than trained
    again: same data, same seed.

    With ``best_only`` the comparison is its first row. The order is that of the test part,
    so the folds of a forest are fitted only if the forest is first: no other figure of
    that row depends on them.
    """
    spark = rows.sparkSession
    options = {k: v for k, v in kwargs.items() if k != "max_bins"}
    late = FOLDS_LATE if best_only and folds else ()
    with prepared(rows, folds=folds, **options) as p:

        def train(model_type: str, folds: int | None = folds, **form) -> RegressionFit:
            return train_regression(p.parts, model_type, folds=folds, ready=p, **kwargs, **form)

        fits = at_once(
            spark, lambda m: train(m, None) if m in late else train(m), model_types, width=3
        )
        table = comparison_table(spark, fits)
        first = table.first()["model"]
        best = next(f for f in fits if f.model_type == first)
        if first in late:
            best.metrics |= train(first, final=False).metrics
    return comparison_table(spark, [best]) if best_only else table, best


def evaluate(model: PipelineModel, rows: DataFrame, target: str = REGRESSION_TARGET) -> DataFrame:
    """RMSE, MAE, R2 of the clipped predictions."""
    scored = predict_clipped(model, rows).withColumnRenamed(target, "actual")
    return regression_metrics(scored)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
