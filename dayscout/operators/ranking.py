"""Ranking without unbounded groups, and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayscout.functions.scoring import cluster_comfort_gauss, cluster_comfort_linear
from dayscout.sources.store import shared_dir


def rank_within(
    rows: DataFrame, group: Sequence[str], score: str, tie: str = "city", out: str = "rank"
) -> DataFrame:
    """Rank 1..n in each group by score descending, then by ``tie`` ascending.

    A group may be any size (all places of one hot date), so it is not sorted in one
    task: rows are dealt by ranges of (group, score, tie) and sorted once; a rank is the
    row's place in its range plus the rows of the group in the ranges before, which come
    from one count per range and group. The dealt rows are checkpointed, so that the
    places and the counts are of the same ranges.
    """
    shared_dir(rows.sparkSession)
    keys = [*[F.col(g) for g in group], F.col(score).desc_nulls_last(), F.col(tie).asc()]
    number = F.monotonically_increasing_id()
    placed = (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", number)
        .withColumn("_range", F.shiftright(F.col("_at"), 33))
        .checkpoint()
    )
    ranges = placed.groupBy(*group, "_range").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_size")
    )
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_size").over(before), F.lit(0))
    offsets = ranges.select(*group, "_range", "_first", ahead.alias("_ahead"))
    return (
        placed.alias("n")
        .join(offsets.alias("a"), _same("n", "a", [*group, "_range"]))
        .select(
            *[F.col(f"n.{c}") for c in rows.columns],
            (F.col("_at") - F.col("_first") + F.col("_ahead") + 1).cast("int").alias(out),
        )
    )


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality on all keys of two aliased sides."""
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(and_, pairs)


def top_k(rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group. Spark keeps only k rows per group and map task
    before the exchange (window group limit), so hot groups stay small."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def top_k_ranked(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rank"
) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def top_n(rows: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top n; planned as TakeOrderedAndProject."""
    return rows.orderBy(*order).limit(n)


def by_score(score: str, tie: str = "city") -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col(tie).asc()]


def by_stars(name: str = "hotel_name") -> list[Column]:
    """Stars descending with unrated last, then name."""
    return [F.col("stars").desc_nulls_last(), F.col(name).asc()]


def by_stars_zero(name: str = "hotel_name") -> list[Column]:
    """Stars descending with unrated counted as zero, then name."""
    return [F.coalesce("stars", F.lit(0)).desc(), F.col(name).asc()]


def rank_clusters(stats: DataFrame, form: str = "gauss", group: Sequence[str] = ()) -> DataFrame:
    """Clusters from best to worst by their mean weather; ties by cluster id.

    One row per cluster (and group) comes in, so the window is tiny by construction.
    """
    forms = {"gauss": cluster_comfort_gauss, "linear": cluster_comfort_linear}
    comfort = forms[form](F.col("avg_temp"), F.col("avg_precip"), F.col("avg_wind"))
    scored = stats.withColumn("cluster_comfort", comfort)
    w = Window.partitionBy(*group).orderBy(F.col("cluster_comfort").desc(), F.col("cluster_id"))
    return scored.withColumn("cluster_rank", F.row_number().over(w))


def good_clusters(ranked: DataFrame, keep: int = 2, group: Sequence[str] = ()) -> DataFrame:
    return ranked.where(F.col("cluster_rank") <= keep).select(*group, "cluster_id")


def keep_good_clusters(
    rows: DataFrame, ranked: DataFrame, keep: int = 2, group: Sequence[str] = ()
) -> DataFrame:
    """Semi-join with the best clusters."""
    return rows.join(good_clusters(ranked, keep, group), [*group, "cluster_id"], "left_semi")
