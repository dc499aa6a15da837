"""Lodging enrichment of the recommended places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.operators.places import JOB_RADIUS_M, radius_join, stale_places, top_places
from dayscout.operators.ranking import by_stars_zero, top_k
from dayscout.operators.writes import one_per_key, upsert_replace
from dayscout.schemas import POIS
from dayscout.sources.poi_elements import parse_elements
from dayscout.sources.scans import When, day
from dayscout.sources.store import shared_dir


def targets(recs: DataFrame, pois: DataFrame, as_of: When, n: int = 5) -> DataFrame:
    return stale_places(top_places(recs, n), pois, as_of)


def fetch_for_places(
    target_places: DataFrame,
    places: DataFrame,
    elements: DataFrame,
    as_of: When,
    radius_m: float = JOB_RADIUS_M,
    k: int = 10,
) -> DataFrame:
    """The k best parsed elements around each target place, then one row per key.

    ``elements`` carries the JSON text only; the place an element belongs to is the
    place whose circle it lies in.
    """
    wanted = places.join(target_places.select("city"), "city", "left_semi")
    found = radius_join(wanted, parse_elements(elements), radius_m)
    rows = found.withColumnRenamed("place", "city").drop("distance_m")
    # Ties in (stars, name) are settled by position, so the result is repeatable.
    order = [*by_stars_zero(), F.col("latitude").desc(), F.col("longitude").desc()]
    best = one_per_key(top_k(rows, ["city"], order, k), POIS.key, order)
    return best.withColumn("fetched_at", day(as_of))


def enrich(
    recs: DataFrame,
    places: DataFrame,
    pois: DataFrame,
    elements: DataFrame,
    as_of: When,
    radius_m: float = JOB_RADIUS_M,
) -> DataFrame:
    """The new state of the points-of-interest table."""
    shared_dir(recs.sparkSession)
    # At most n places, then at most k rows for each: written out once, since both the
    # next step and the upsert refer to them more than once.
    wanted = targets(recs, pois, as_of).checkpoint()
    fetched = fetch_for_places(wanted, places, elements, as_of, radius_m).checkpoint()
    return upsert_replace(pois, fetched.select(*pois.columns), POIS.key, by_stars_zero())
