"""Scraped map elements: JSON with a free-form tag map to flat lodging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.functions import text

ELEMENT_SCHEMA = (
    "type STRING, lat DOUBLE, lon DOUBLE, center STRUCT<lat: DOUBLE, lon: DOUBLE>,"
    "tags MAP<STRING, STRING>"
)
# Fixed value: where the elements come from.
DATA_SOURCE = "openstreetmap"


def parse_elements(elements: DataFrame, element: str = "element") -> DataFrame:
    """One row per element with a name and a coordinate; the others are dropped.

    Columns of the input other than the JSON text (such as ``city``) are kept.
    """
    kept = [c for c in elements.columns if c != element]
    # As a generator, so the filters below are not pushed into the parsing and the JSON
    # is read once per element.
    one = F.array(F.from_json(element, ELEMENT_SCHEMA))
    parsed = elements.select(*kept, F.inline(one).alias("type", "lat", "lon", "center", "tags"))
    kind, tags, centre = F.col("type"), F.col("tags"), F.col("center")
    rows = parsed.select(
        *kept,
        text.non_empty(text.tag(tags, "name")).alias("hotel_name"),
        text.tag_or_default(tags, "tourism", "hotel").alias("hotel_type"),
        text.star_rating(tags).alias("stars"),
        text.address_line(tags).alias("address"),
        text.picked_coordinates(kind, F.col("lat"), centre["lat"]).alias("latitude"),
        text.picked_coordinates(kind, F.col("lon"), centre["lon"]).alias("longitude"),
        text.website(tags).alias("website_url"),
        text.amenities(tags).alias("amenities"),
        F.lit(DATA_SOURCE).alias("data_source"),
    )
    return rows.where(
        F.col("hotel_name").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
    )
