"""Joins around recommended places: radius search, staleness, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayscout.functions.geo import Grid, haversine
from dayscout.operators.ranking import by_score, by_stars, top_k_ranked, top_n
from dayscout.sources.scans import When, day

# The lodging types a radius search returns.
LODGING_TYPES = ["hotel", "guest_house", "apartment", "hostel"]
DEFAULT_RADIUS_M = 10_000.0
JOB_RADIUS_M = 8_000.0
FRESH_DAYS = 14


#: points that a cell holds before it is split, and the most times it is halved
CROWDED, DEEPEST = 100_000, 6


def crowded_cells(points: DataFrame, grid: Grid, crowded: int = CROWDED) -> DataFrame:
    """(_at, _level) of the cells with more than ``crowded`` points: how often a cell is
    halved, in height and width, until no part of it holds more. Points are counted in the
    finest parts first; coarser ones are sums of those."""
    at, lat, lon = F.col("_cell"), F.col("latitude"), F.col("longitude")
    crowds = (
        points.groupBy(at.alias("_at")).agg(F.count("*").alias("_n")).where(F.col("_n") > crowded).select("_at")
    )
    finest = (
        points.join(crowds, at == F.col("_at"))
        .groupBy("_at", grid.part(lat, lon, at, F.lit(DEEPEST)).alias("p"))
        .agg(F.count("*").alias("n"))
    )
    halved = F.pow(F.lit(2.0), DEEPEST - F.col("_level")).cast("long")
    up, along = (F.floor(F.col(f"p.{side}") / halved) for side in ("up", "along"))
    deep = (
        finest.withColumn("_level", F.explode(F.sequence(F.lit(1), F.lit(DEEPEST))))
        .groupBy("_at", "_level", up.alias("up"), along.alias("along"))
        .agg(F.sum("n").alias("n"))
        .groupBy("_at", "_level")
        .agg(F.max("n").alias("n"))
    )
    enough = F.when((F.col("n") <= crowded) | (F.col("_level") == DEEPEST), F.col("_level"))
    return deep.groupBy("_at").agg(F.min(enough).alias("_level"))


def _split(rows: DataFrame, crowds: DataFrame) -> DataFrame:
    level = F.coalesce("_level", F.lit(0))
    return rows.join(crowds, F.col("_cell") == F.col("_at"), "left").withColumn("_level", level).drop("_at")


def radius_join(
    places: DataFrame,
    pois: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    types: Sequence[str] = tuple(LODGING_TYPES),
    crowded: int = CROWDED,
) -> DataFrame:
    """Points of interest within ``radius_m`` metres of each place, anywhere on the globe.

    A place is expanded to the grid cells its circle may touch, a point lies in one cell:
    an equi-join on the cell, then the exact distance. Cells are as fine as the points in
    them ask for: one with more than ``crowded`` points is split until no part holds more
    (4,096 parts at most), and a place meets those parts of it that its circle may touch. Points of one coordinate
    cannot be split; AQE's skew join deals them out.
    """
    grid = Grid.for_radius(radius_m)
    centres = places.select(
        F.col("city").alias("place"),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
        F.explode(grid.neighbourhood(F.col("latitude"), F.col("longitude"))).alias("_cell"),
    )
    points = pois.where(F.col("hotel_type").isin(list(types))).withColumn(
        "_cell", grid.cell(F.col("latitude"), F.col("longitude"))
    )
    crowds = crowded_cells(points, grid, crowded)
    cell, level = F.col("_cell"), F.col("_level")
    leaves = _split(centres, crowds).withColumn(
        "_part", F.explode(grid.parts(F.col("_lat"), F.col("_lon"), cell, level))
    )
    placed = _split(points, crowds).withColumn(
        "_part", grid.part(F.col("latitude"), F.col("longitude"), cell, level)
    )
    distance = haversine(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    return (
        placed.join(leaves.drop("_level"), ["_cell", "_part"])
        .withColumn("distance_m", distance)
        .where(F.col("distance_m") <= radius_m)
        .drop("_cell", "_part", "_level", "_lat", "_lon")
    )


def latest_batch(recs: DataFrame, stamp: str = "recommendation_date") -> DataFrame:
    """Rows of the newest batch: a scalar subquery, no join."""
    newest = recs.agg(F.max(stamp)).scalar()
    return recs.where(F.col(stamp) == newest)


def top_places(recs: DataFrame, n: int = 5, stamp: str = "recommendation_date") -> DataFrame:
    """The n places with the best score in the newest batch, each once."""
    best = latest_batch(recs, stamp).groupBy("city").agg(
        F.max("comfort_score_pred").alias("score")
    )
    return top_n(best, by_score("score"), n)


def fresh_places(pois: DataFrame, as_of: When, days: int = FRESH_DAYS) -> DataFrame:
    return (
        pois.where(F.col("fetched_at") >= F.date_sub(day(as_of), days)).select("city").distinct()
    )


def stale_places(
    top: DataFrame, pois: DataFrame, as_of: When, fallback: int = 2, days: int = FRESH_DAYS
) -> DataFrame:
    """Top places without fresh data; if every one is fresh, the first ``fallback``.

    ``top`` is a top-n, so the unpartitioned windows see a handful of rows; one pass
    over it does for both cases.
    """
    fresh = fresh_places(pois, as_of, days).withColumn("_fresh", F.lit(True))
    is_stale = F.col("_fresh").isNull()
    position = F.row_number().over(Window.partitionBy().orderBy(*by_score("score")))
    n_stale = F.count_if(is_stale).over(Window.partitionBy())
    return (
        top.join(fresh, "city", "left")
        .select("city", "score", "_fresh", position.alias("_position"), n_stale.alias("_stale"))
        .where(is_stale | ((F.col("_stale") == 0) & (F.col("_position") <= fallback)))
        .select("city", "score")
    )


def set_difference(top: DataFrame, done: DataFrame) -> DataFrame:
    return top.select("city").join(done.select("city").distinct(), "city", "left_anti")


def recommendations_with_places(recs: DataFrame, places: DataFrame, scores: DataFrame) -> DataFrame:
    """Recommendations with coordinates (inner) and the actual score (left)."""
    actual = scores.select(
        "city",
        F.col("feature_date").alias("recommendation_date"),
        "profile_name",
        F.col("comfort_score").alias("actual_score"),
    )
    return recs.join(places, "city").join(
        actual, ["city", "recommendation_date", "profile_name"], "left"
    )


def with_weather_for_top(recs: DataFrame, features: DataFrame, top: int = 5) -> DataFrame:
    """Attach the 3-day features to places ranked at most ``top``; others get NULLs."""
    weather = features.select(
        F.col("feature_date").alias("recommendation_date"),
        "city",
        "temp_mean_3d",
        "precip_sum_3d",
        "wind_max_3d",
    )
    wanted = F.when(F.col("rank") <= top, F.col("city"))
    left = recs.withColumn("_wanted", wanted).alias("r")
    right = weather.alias("w")
    on = (F.col("r._wanted") == F.col("w.city")) & (
        F.col("r.recommendation_date") == F.col("w.recommendation_date")
    )
    return left.join(right, on, "left").select(
        "r.*", "w.temp_mean_3d", "w.precip_sum_3d", "w.wind_max_3d"
    ).drop("_wanted")


def top_pois(places: DataFrame, pois: DataFrame, k: int = 5) -> DataFrame:
    """The k best-rated points of interest of each given place.

    The top-k comes before the join, so at most k rows per place take part in it.
    """
    wanted = pois.join(places.select("city").distinct(), "city", "left_semi")
    return top_k_ranked(wanted, ["city"], by_stars(), k, out="poi_rank")
