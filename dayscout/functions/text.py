"""String, map and number-parsing expressions for scraped point-of-interest tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"


def non_empty(x: Column) -> Column:
    return F.when(x != "", x)


def safe_float(x: Column) -> Column:
    """Text to a finite double, or NULL. Stricter than a bare cast, which accepts '1d'."""
    return F.when(x.rlike(_DECIMAL), F.trim(x).try_cast("double"))


def safe_int(x: Column) -> Column:
    """Text to int, or NULL: '4' and ' 4 ' parse, '3.7' and '4S' do not."""
    return F.when(x.rlike(_INTEGER), F.trim(x).try_cast("int"))


def safe_int_number(x: Column) -> Column:
    """A numeric value is truncated towards zero; NaN and out-of-range give NULL."""
    whole = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x))
    return F.when(~F.isnan(x) & F.abs(x).between(0, 2147483647), whole.cast("int"))


# Tag keys that may hold a star rating, in order of preference.
STAR_KEYS = ["stars", "star", "rating"]
# Tag keys of the address parts, in output order.
ADDRESS_KEYS = ["addr:housenumber", "addr:street", "addr:city", "addr:postcode"]
# Tag keys that may hold a website, in order of preference.
WEBSITE_KEYS = ["website", "contact:website", "url", "homepage"]
# Amenity tag and the label it becomes, in output order.
AMENITY_LABELS = [
    ("internet_access", "wifi"),
    ("wifi", "wifi"),
    ("parking", "parking"),
    ("restaurant", "restaurant"),
    ("bar", "bar"),
    ("breakfast", "breakfast"),
    ("air_conditioning", "ac"),
    ("swimming_pool", "pool"),
    ("spa", "spa"),
    ("fitness_centre", "gym"),
    ("wheelchair", "accessible"),
]
# Tag values that switch an amenity on.
AMENITY_ON = ["yes", "true", "1"]


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def tag_or_default(tags: Column, key: str, default: str) -> Column:
    return F.coalesce(tag(tags, key), F.lit(default))


def tag_values(tags: Column, keys: list[str]) -> Column:
    """The values of several tags in the order of ``keys``, NULL where absent.

    As an array with higher-order functions on top, the expressions below stay small:
    spelled out per key, the generated code outgrows what the JVM compiles.
    """
    return F.transform(F.array(*[F.lit(k) for k in keys]), lambda k: F.try_element_at(tags, k))


def star_rating(tags: Column) -> Column:
    """First candidate in 1..5; failing that, the last candidate that parses at all."""
    parsed = F.array_compact(F.transform(tag_values(tags, STAR_KEYS), lambda x: safe_int(x)))
    in_range = F.filter(parsed, lambda x: x.between(1, 5))
    return F.coalesce(F.get(in_range, F.lit(0)), F.try_element_at(parsed, F.lit(-1)))


def address_line(tags: Column) -> Column:
    """Non-empty address parts joined by ', '; NULL when there are none."""
    parts = F.filter(tag_values(tags, ADDRESS_KEYS), lambda x: x != "")
    return non_empty(F.array_join(parts, ", "))


def website(tags: Column) -> Column:
    """First non-empty website tag, trimmed, with a scheme.

    A tag of blanks only is picked (it is not empty) and becomes the empty string.
    """
    picked = F.get(F.filter(tag_values(tags, WEBSITE_KEYS), lambda x: x != ""), F.lit(0))
    url = F.regexp_replace(picked, r"^\s+|\s+$", "")
    return F.regexp_replace(url, r"^(?!https?://)(?=.)", "https://")


def amenities(tags: Column) -> Column:
    """Labels of the amenities switched on, comma separated, or NULL."""
    known = F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit(v).alias("label")) for k, v in AMENITY_LABELS]
    )
    on = F.filter(known, lambda a: F.try_element_at(tags, a["key"]).isin(AMENITY_ON))
    return non_empty(F.array_join(on["label"], ","))


def split_amenities(x: Column) -> Column:
    return F.transform(F.split(x, ","), lambda part: F.trim(part))


def capitalised_label(icon: Column, name: Column) -> Column:
    """Icon, a space, and the name with only its first letter in upper case."""
    head = F.upper(F.substring(name, 1, 1))
    rest = F.lower(F.substring(name, F.lit(2), F.length(name)))
    return F.concat(icon, F.lit(" "), head, rest)


def picked_coordinates(kind: Column, own: Column, centre: Column) -> Column:
    """A node has its own coordinate; other elements use their centre."""
    return F.when(kind == "node", own).otherwise(centre)


def cluster_line(cluster_id, size, temp, rain, wind) -> Column:
    """One line of the cluster breakdown; the three means have one decimal."""
    return F.format_string(
        "cluster_%d: size=%d, temp=%.1f°C, precip=%.1fmm, wind=%.1f km/h",
        cluster_id, size, temp, rain, wind,
    )
