"""Silhouettes: the exact Euclidean one, and the linear-cost squared one.

The exact mean distance to a cluster does not decompose, so the work is quadratic by
nature. It is done in square tiles: points are dealt to 2g bands by a hash, and a tile is a
pair of bands, or a band with itself. A distance counts for both of its points, so each is
computed once and each pair of bands is one tile. A point travels 2g times, and with bands
as long as the square root of all points, the exchange grows with n to the power 1.5. Every
tile is a partition of its own. Numpy sums the distances inside a tile. What leaves it is one
partial sum per point and cluster, never a pair of points.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

#: two bands are this many times the square root of the points long
STRIP = 64
#: partitions of the tiles at most; beyond, a partition holds several
PARTITIONS = 10_000
#: rows and columns of the distances that are in memory at once, few enough for a cache. Not a
#: power of two: rows that far apart share a cache's places, which costs a sixth of the product
BLOCK = 500
#: stands for no cluster beside cluster ids, which are ints; sorts last as NULL does
NONE = 1 << 31

#: from this many dimensions on, distances come from a matrix product
PRODUCT = 8
#: part of |x|^2 + |y|^2 below which a squared distance is not left to the product
CLOSE = 1e-4

_PARTIAL = "id string, cluster_id int, sums array<struct<other: int, total: double>>"


def _differences(x: Sequence[np.ndarray], y: Sequence[np.ndarray], out: np.ndarray) -> np.ndarray:
    """Squared distances of every x to every y, dimension by dimension."""
    out[:] = 0
    for a, b in zip(x[0].T.copy(), y[0].T.copy(), strict=True):
        step = a[:, None] - b
        step *= step
        out += step
    return out


def _factors(x: np.ndarray, y: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Of both sides the points around the middle of y, their squares, and rows whose products
    are |x|^2 + |y|^2 - 2xy."""
    middle = y.mean(axis=0)
    middle[~np.isfinite(middle)] = 0  # a NaN stays with its own pairs
    x, y = x - middle, y - middle
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    one = np.ones_like
    return (x, xx, np.column_stack([x, xx, one(xx)])), (y, yy, np.column_stack([-2 * y, one(yy), yy]))


def _product(x: Sequence[np.ndarray], y: Sequence[np.ndarray], out: np.ndarray) -> np.ndarray:
    """Squared distances by one matrix product of factors. That loses the digits of points
    that lie close, compared to how far out they are; those pairs are done anew."""
    (x, xx, left), (y, yy, right) = x, y
    np.matmul(left, right.T, out=out)
    farthest = np.fmax.reduce(xx) + np.fmax.reduce(yy)  # of those without NaN
    near = np.flatnonzero(out < CLOSE * farthest)  # few, and one pass finds them
    for part in np.array_split(near, -(-len(near) // (1 << 14)) or 1):
        i, j = np.divmod(part, len(y))
        close = out.flat[part] < CLOSE * (xx[i] + yy[j])
        i, j = i[close], j[close]
        out[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return out


def _measured(x: np.ndarray, y: np.ndarray) -> tuple[Callable, tuple, tuple]:
    """How squared distances are found, and what of both sides it takes."""
    if x.shape[1] < PRODUCT:
        return _differences, (x,), (y,)
    return _product, *_factors(x, y)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of every x to every y."""
    measure, left, right = _measured(x, y)
    return measure(left, right, np.empty((len(x), len(y))))


def _parts(starts: np.ndarray, low: int, high: int) -> tuple[slice, np.ndarray]:
    """Which of the runs that begin at ``starts`` reach into low..high, and where there."""
    runs = slice(np.searchsorted(starts, low, "right") - 1, np.searchsorted(starts, high))
    return runs, np.maximum(starts[runs] - low, 0)


def _sums(
    x: np.ndarray, y: np.ndarray, x_runs: np.ndarray, y_runs: np.ndarray, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Distance sums of every x to each run of y, and of every y to each run of x. With
    ``same``, x and y are the same points and the second is the first."""
    to_y = np.zeros((len(x), len(y_runs)))
    to_x = to_y if same else np.zeros((len(y), len(x_runs)))
    measure, left, right = _measured(x, y)
    held = np.empty(BLOCK * BLOCK)  # one for all blocks: new memory costs as much as a pass
    for i in range(0, len(x), BLOCK):
        i_end = min(i + BLOCK, len(x))
        rows, row_starts = _parts(x_runs, i, i_end)
        row_ends = [*row_starts[1:], i_end - i]
        for j in range(i if same else 0, len(y), BLOCK):
            j_end = min(j + BLOCK, len(y))
            columns, column_starts = _parts(y_runs, j, j_end)
            block = held[: (i_end - i) * (j_end - j)].reshape(i_end - i, j_end - j)
            measure([v[i:i_end] for v in left], [v[j:j_end] for v in right], block)
            np.sqrt(block, out=block)
            to_y[i:i_end, columns] += np.add.reduceat(block, column_starts, axis=1)
            if same and i == j:
                continue
            for run, start, end in zip(range(rows.start, rows.stop), row_starts, row_ends, strict=True):
                to_x[j:j_end, run] += block[start:end].sum(axis=0)
    return to_y, to_x


def _vectors(features: pa.ChunkedArray) -> np.ndarray:
    features = features.combine_chunks()
    lengths = pc.unique(pc.list_value_length(features)).to_pylist()
    if len(lengths) != 1 or lengths[0] is None:
        raise ValueError("all points must have vectors of the same length")
    values = features.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return values.reshape(len(features), lengths[0])


def _runs(clusters: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(clusters, prepend=clusters[0] - 1))


def _partial(points: pa.Table, others: np.ndarray, sums: np.ndarray) -> pa.Table:
    known = others != NONE
    others, sums = others[known], sums[:, known]
    pairs = pa.StructArray.from_arrays(
        [pa.array(np.tile(others, len(sums)), pa.int32()), pa.array(sums.ravel())], ["other", "total"]
    )
    offsets = np.arange(len(sums) + 1, dtype="int32") * np.int32(len(others))
    lists = pa.ListArray.from_arrays(pa.array(offsets), pairs)
    return pa.table({"id": points["id"], "cluster_id": points["cluster_id"], "sums": lists})


def _tile_sums(tile: pa.Table) -> pa.Table:
    """For every point, its distance sum to each cluster of the other band (of its own on the
    diagonal, where all sides are 0)."""
    tile = tile.sort_by([("side", "ascending"), ("cluster_id", "ascending")])
    side = tile["side"].to_numpy()
    clusters = pc.fill_null(tile["cluster_id"].cast("int64"), NONE).to_numpy()
    vectors = _vectors(tile["features"])
    if side[0] == 0:
        runs = _runs(clusters)
        return _partial(tile, clusters[runs], _sums(vectors, vectors, runs, runs, True)[0])
    cut = np.searchsorted(side, 1)
    if cut in (0, len(side)):  # nothing fell into the other band
        return _partial(tile[:0], clusters[:0], np.zeros((0, 0)))
    runs = _runs(clusters[:cut]), _runs(clusters[cut:])
    others = [clusters[:cut][runs[0]], clusters[cut:][runs[1]]]
    left, right = _sums(vectors[:cut], vectors[cut:], *runs, False)
    return pa.concat_tables([_partial(tile[:cut], others[1], left), _partial(tile[cut:], others[0], right)])


def strips_for(n_points: int) -> int:
    return max(1, math.ceil(math.sqrt(n_points) / STRIP))


def tiles(points: DataFrame, strips: int) -> DataFrame:
    """Each point once per band: in the tile of its own band with that one. Pairs of the
    2 ``strips`` bands are numbered without gaps; ``side`` tells the bands of a tile apart."""
    band = F.pmod(F.xxhash64("id"), F.lit(2 * strips)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(2 * strips - 1)))
    low, high = F.least("band", "met"), F.greatest("band", "met")
    tile = (high * (high + 1) / 2 + low).cast("int")
    side = F.signum(F.col("met") - F.col("band")).cast("int")
    met = points.select(band.alias("band"), every.alias("met"), *points.columns)
    return met.select(tile.alias("tile"), side.alias("side"), *points.columns)


def silhouette_samples(
    points: DataFrame, n_points: int | None = None, strips: int | None = None
) -> DataFrame:
    """(id, cluster_id, silhouette) for points (id, cluster_id, features array<double>).

    A point alone in its cluster scores 0, and so does everything when there is only
    one cluster.
    """
    # floats travel as they are: half the bytes, and doubles hold their values
    floats = points.schema["features"].dataType == ArrayType(FloatType())
    points = points.select(
        F.col("id").cast("string").alias("id"),
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.col("features").cast("array<float>" if floats else "array<double>").alias("features"),
    )
    if strips is None:
        strips = strips_for(points.count() if n_points is None else n_points)
    dealt = tiles(points, strips).repartitionById(min(strips * (2 * strips + 1), PARTITIONS), "tile")
    # a tile has a point once, so its sums can only be added after they have met others; until
    # then they travel as one row
    met = dealt.groupBy("tile").applyInArrow(_tile_sums, _PARTIAL).repartition("id")
    partial = met.select("id", "cluster_id", F.inline("sums"))
    sizes = points.groupBy(F.col("cluster_id").alias("other")).agg(F.count("*").alias("size"))
    totals = partial.groupBy("id", "cluster_id", "other").agg(F.nanvl(F.sum("total"), F.lit(None)).alias("total"))
    own = F.col("other") == F.col("cluster_id")
    per_point = (
        totals.join(sizes, "other")
        .groupBy("id", "cluster_id")
        .agg(
            F.max(F.when(own, F.col("size"))).alias("own_size"),
            F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
        )
    )
    a, b = F.col("a"), F.col("b")
    wide = F.nullif(F.greatest(a, b), F.lit(0.0))
    alone = (F.col("own_size") == 1) | b.isNull()
    score = F.when(alone, 0.0).otherwise(F.coalesce((b - a) / wide, F.lit(0.0)))
    return per_point.select("id", "cluster_id", score.alias("silhouette"))


def silhouette_exact(points: DataFrame, **kwargs) -> DataFrame:
    """Mean Euclidean silhouette over all points (one row)."""
    return silhouette_samples(points, **kwargs).agg(
        F.coalesce(F.avg("silhouette"), F.lit(0.0)).alias("silhouette_score"),
        F.count("*").alias("n_points"),
        F.countDistinct("cluster_id").alias("n_clusters"),
    )


def silhouette_by_cluster(points: DataFrame, **kwargs) -> DataFrame:
    return (
        silhouette_samples(points, **kwargs)
        .groupBy("cluster_id")
        .agg(F.avg("silhouette").alias("silhouette_score"), F.count("*").alias("n_points"))
    )


def silhouette_squared(
    clustered: DataFrame, features: str = "scaled", prediction: str = "cluster_id"
) -> float:
    """Silhouette on squared distances: one pass, for frames too large for the exact one."""
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=prediction, distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(clustered)


def as_points(clustered: DataFrame, features: str = "scaled") -> DataFrame:
    """Points frame from an MLlib frame with a vector column; each row is a point of its
    own. Pass a persisted frame: the row numbers are those of its partitions."""
    from pyspark.ml.functions import vector_to_array

    return clustered.select(
        F.monotonically_increasing_id().alias("id"),
        "cluster_id",
        vector_to_array(features).alias("features"),
    )
