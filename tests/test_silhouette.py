"""Tiles of the exact silhouette: each distance once, blocks of any size, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayscout.operators import silhouette


def points_of(spark, x, labels):
    rows = [(i, c, [float(a) for a in v]) for i, (v, c) in enumerate(zip(x, labels, strict=True))]
    return spark.createDataFrame(rows, "id string, cluster_id int, features array<double>")


def between(x, y):
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))


@pytest.fixture
def counted(monkeypatch):
    """How many distances each call measures."""
    pairs = []
    for name in ("_differences", "_product"):
        measure = getattr(silhouette, name)
        monkeypatch.setattr(
            silhouette, name, lambda x, y, out, measure=measure: pairs.append(out.size) or measure(x, y, out)
        )
    return pairs


@pytest.mark.parametrize("dimensions", [2, 16])
def test_each_distance_is_computed_once(spark, counted, monkeypatch, dimensions):
    """Both points of a pair take it from one tile."""
    n, strips = 200, 2
    monkeypatch.setattr(silhouette, "BLOCK", 7)
    x = np.random.default_rng(3).normal(size=(n, dimensions))
    labels = [i % 3 for i in range(n)]
    frame = silhouette.tiles(points_of(spark, x, labels), strips).toPandas()
    assert sorted(frame["tile"].unique()) == list(range(strips * (2 * strips + 1)))
    totals = np.zeros((n, 3))
    for _, tile in frame.groupby("tile"):
        for r in silhouette._tile_sums(pa.Table.from_pandas(tile, preserve_index=False)).to_pylist():
            for s in r["sums"]:
                totals[int(r["id"]), s["other"]] += s["total"]
    want = np.stack([between(x, x[c::3]).sum(axis=1) for c in range(3)], axis=1)
    assert np.allclose(totals, want)
    assert sum(counted) < 0.55 * n * n


@pytest.mark.parametrize("block", [1, 4, 500])
@pytest.mark.parametrize("dimensions", [3, 24])
def test_sums_do_not_depend_on_the_blocks(monkeypatch, block, dimensions):
    monkeypatch.setattr(silhouette, "BLOCK", block)
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(11, dimensions)) + 50, rng.normal(size=(17, dimensions)) + 50
    y[:5] = x[:5]
    x_runs, y_runs = np.array([0, 1, 6]), np.array([0, 2, 3, 16])
    to_y, to_x = silhouette._sums(x, y, x_runs, y_runs, False)
    apart = between(x, y)
    assert np.allclose(to_y, np.add.reduceat(apart, y_runs, axis=1), atol=1e-9)
    assert np.allclose(to_x, np.add.reduceat(apart, x_runs, axis=0).T, atol=1e-9)
    own = silhouette._sums(x, x, x_runs, x_runs, True)[0]
    assert np.allclose(own, np.add.reduceat(between(x, x), x_runs, axis=1), atol=1e-9)


def test_every_tile_is_a_task_of_its_own(spark):
    """However few shuffle partitions the session has, and whatever their bytes."""
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    points = points_of(spark, np.zeros((40, 2)), [0] * 40)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        plan = silhouette.silhouette_samples(points, strips=3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    above, _, below = plan.partition("FlatMapGroupsInArrow")
    assert above and below.count("Exchange") == 2  # of the tiles, of the cluster sizes
    assert "direct_shuffle_partition_id(tile" in below and ", 21), REPARTITION_BY_NUM" in below


def test_partitions_may_hold_several_tiles(spark, monkeypatch):
    points = points_of(spark, np.random.default_rng(2).normal(size=(40, 2)), [i % 2 for i in range(40)])
    own = {r["id"]: r["silhouette"] for r in silhouette.silhouette_samples(points, strips=3).collect()}
    monkeypatch.setattr(silhouette, "PARTITIONS", 4)
    few = {r["id"]: r["silhouette"] for r in silhouette.silhouette_samples(points, strips=3).collect()}
    assert len(own) == 40 and few == pytest.approx(own, abs=1e-12)


def test_a_point_without_a_cluster_scores_zero_and_counts_for_none(spark):
    x = np.array([[0.0, 0], [1, 0], [5, 5], [6, 5], [3, 3]])
    with_one = silhouette.silhouette_samples(points_of(spark, x, [0, 0, 1, 1, None])).collect()
    without = silhouette.silhouette_samples(points_of(spark, x[:4], [0, 0, 1, 1])).collect()
    found = {r["id"]: (r["cluster_id"], r["silhouette"]) for r in with_one}
    assert found.pop("4") == (None, 0.0)
    assert found == {r["id"]: (r["cluster_id"], pytest.approx(r["silhouette"])) for r in without}


@pytest.mark.parametrize("dimensions", [2, 16])
def test_a_nan_stays_with_its_own_cluster(spark, dimensions):
    """Points compare themselves with the clusters whose distances are known."""
    x = np.random.default_rng(8).normal(size=(30, dimensions))
    labels = [i % 3 for i in range(30)]
    x[2, 0] = np.nan
    got = {int(r["id"]): r["silhouette"] for r in silhouette.silhouette_samples(points_of(spark, x, labels)).collect()}
    a = between(x[0::3], x[0::3]).sum(axis=1) / 9
    b = between(x[0::3], x[1::3]).mean(axis=1)
    assert np.allclose([got[i] for i in range(0, 30, 3)], (b - a) / np.maximum(a, b))


def test_floats_travel_as_floats(spark):
    points = points_of(spark, np.random.default_rng(9).normal(size=(50, 12)).astype("float32"), [i % 2 for i in range(50)])
    short = points.withColumn("features", F.col("features").cast("array<float>"))
    plan = silhouette.silhouette_samples(short, strips=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "as array<double>" not in plan
    a, b = (
        {r["id"]: r["silhouette"] for r in silhouette.silhouette_samples(p, strips=2).collect()} for p in (short, points)
    )
    assert a == pytest.approx(b, abs=1e-12) and len(a) == 50


def test_vectors_of_different_lengths_are_refused():
    with pytest.raises(ValueError, match="same length"):
        silhouette._vectors(pa.chunked_array([[[1.0, 2.0, 3.0], [4.0]]]))
