"""Scalar functions."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check
from checks.sinks import DRIFT_REPLAY_SQL
from dayscout.functions import drift_rules as rules
from dayscout.functions import scoring, text
from dayscout.plans import drift
from dayscout.sources.poi_elements import ELEMENT_SCHEMA


def _customers(spark, d):
    return c.table(spark, d, "customer").select("c_custkey", "c_acctbal")


@check(
    "safe_float",
    """SELECT c_custkey, CASE c_custkey%8 WHEN 0 THEN c_acctbal WHEN 1 THEN c_acctbal
         WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN c_acctbal*100
         WHEN 6 THEN NULL ELSE NULL END AS parsed FROM customer""",
)
def safe_float(spark, d):
    """Account balances written in clean and unclean ways."""
    k, x = F.col("c_custkey") % 8, F.col("c_acctbal").cast("string")
    written = (
        F.when(k == 0, x)
        .when(k == 1, F.concat(F.lit("  "), x, F.lit(" ")))
        .when(k == 2, F.concat(x, F.lit("d")))
        .when(k == 3, F.lit("n/a"))
        .when(k == 4, F.lit(""))
        .when(k == 5, F.concat((F.col("c_acctbal") * 100).cast("string")))
        .when(k == 6, F.lit("nan"))
    )
    return _customers(spark, d).select("c_custkey", text.safe_float(written).alias("parsed"))


@check(
    "safe_int",
    """SELECT c_custkey, CAST(CASE c_custkey%6 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey
         WHEN 4 THEN -c_custkey END AS INTEGER) AS from_text,
         CAST(trunc(c_acctbal) AS INTEGER) AS from_number FROM customer""",
)
def safe_int(spark, d):
    k, x = F.col("c_custkey") % 6, F.col("c_custkey").cast("string")
    written = (
        F.when(k == 0, x)
        .when(k == 1, F.concat(F.lit(" "), x, F.lit(" ")))
        .when(k == 2, F.concat(x, F.lit(".7")))
        .when(k == 3, F.concat(x, F.lit("S")))
        .when(k == 4, F.concat(F.lit("-"), x))
        .otherwise(F.lit(""))
    )
    return _customers(spark, d).select(
        "c_custkey",
        text.safe_int(written).alias("from_text"),
        text.safe_int_number(F.col("c_acctbal")).alias("from_number"),
    )


def _tags(spark, d):
    e = c.elements(spark, d).select("city", F.from_json("element", ELEMENT_SCHEMA).alias("e"))
    return e.select("city", "e", F.col("e.tags").alias("tags"), F.col("e.tags")["name"].alias("hotel_name"))


def _of_tags(key, column, sql_column):
    def fn(spark, d):
        return _tags(spark, d).select("hotel_name", column(F.col("tags")).alias(sql_column))

    fn.__name__ = key
    return check(key, f"SELECT hotel_name, {sql_column} FROM parsed_pois")(fn)


_of_tags("star_rating", text.star_rating, "stars")
_of_tags("address_join", text.address_line, "address")
_of_tags("website_normalise", text.website, "website_url")
_of_tags("amenities_list", text.amenities, "amenities")
_of_tags("map_get_default", lambda t: text.tag_or_default(t, "tourism", "hotel"), "hotel_type")


@check(
    "amenities_split",
    """SELECT hotel_name, CAST(t.i-1 AS INTEGER) AS pos, trim(split_part(amenities, ',', CAST(t.i AS BIGINT))) AS amenity
       FROM parsed_pois, range(1, 12) t(i)
       WHERE amenities IS NOT NULL AND t.i <= len(string_split(amenities, ','))""",
)
def amenities_split(spark, d):
    rows = _tags(spark, d).select("hotel_name", text.amenities(F.col("tags")).alias("a"))
    spaced = F.regexp_replace("a", ",", " , ")
    return rows.select("hotel_name", F.posexplode(text.split_amenities(spaced)).alias("pos", "amenity"))


@check("coords_pick", "SELECT hotel_name, latitude, longitude FROM parsed_pois")
def coords_pick(spark, d):
    e = F.col("e")
    return _tags(spark, d).select(
        "hotel_name",
        text.picked_coordinates(e["type"], e["lat"], e["center"]["lat"]).alias("latitude"),
        text.picked_coordinates(e["type"], e["lon"], e["center"]["lon"]).alias("longitude"),
    )


@check(
    "capitalize_label",
    """SELECT hotel_name, stars||' '||upper(left(hotel_type, 1))||lower(substr(hotel_type, 2)) AS label
       FROM pois WHERE stars IS NOT NULL""",
)
def capitalize_label(spark, d):
    rated = c.pois(spark, d).where(F.col("stars").isNotNull())
    label = text.capitalised_label(F.col("stars").cast("string"), F.upper("hotel_type"))
    return rated.select("hotel_name", label.alias("label"))


@check(
    "date_windows",
    """SELECT DISTINCT date AS as_of, date-35 AS baseline_start, date-7 AS baseline_end,
         date-7 AS current_start FROM obs""",
)
def date_windows(spark, d):
    days = c.obs(spark, d).select("date").distinct()
    first, last = rules.baseline_bounds(F.col("date"))
    return days.select(
        F.col("date").alias("as_of"),
        first.alias("baseline_start"),
        last.alias("baseline_end"),
        rules.current_start(F.col("date")).alias("current_start"),
    )


@check("date_format_long", "SELECT DISTINCT date, strftime(date, '%A, %B %d, %Y') AS label FROM obs")
def date_format_long(spark, d):
    days = c.obs(spark, d).select("date").distinct()
    return days.select("date", F.date_format("date", "EEEE, MMMM dd, yyyy").alias("label"))


@check(
    "json_metadata",
    f"""WITH {DRIFT_REPLAY_SQL} SELECT check_date, metric_name, round(shift + 1e-9, 6) AS mean_shift_std,
          baseline_n AS baseline_samples, current_n AS current_samples, threshold AS threshold_used,
          metric_name AS feature_type, TRUE AS p_value_is_a_share, 6 AS n_keys FROM log""",
)
def json_metadata(spark, d):
    """The fields of the logged metadata. The p-value has tests of its own."""
    found = drift.replay_feature_drift(c.features(spark, d))
    log = drift.drift_log_rows(found, F.col("check_date"))
    field = lambda name, kind: F.get_json_object("metadata", f"$.{name}").cast(kind)
    return log.select(
        F.col("check_timestamp").cast("date").alias("check_date"),
        "metric_name",
        (F.round(field("mean_shift_std", "double") + 1e-9, 6)).alias("mean_shift_std"),
        field("baseline_samples", "long").alias("baseline_samples"),
        field("current_samples", "long").alias("current_samples"),
        field("threshold_used", "double").alias("threshold_used"),
        field("feature_type", "string").alias("feature_type"),
        field("p_value", "double").between(0, 1).alias("p_value_is_a_share"),
        F.size(F.json_object_keys("metadata")).alias("n_keys"),
    )


@check(
    "math_core",
    """SELECT city, date, round(exp(-precipitation/5) + 1e-9, 6) AS decayed,
         round(abs(temp_min-20) + 1e-9, 6) AS distance, round(sqrt(wind_speed_max) + 1e-9, 6) AS root,
         round(pow(temp_max, 2) + 1e-9, 6) AS squared, round(temp_max*wind_gusts_max/7, 2) AS rounded,
         greatest(0, least(30, temp_min)) AS clipped FROM obs""",
)
def math_core(spark, d):
    return c.obs(spark, d).select(
        "city",
        "date",
        c.r6(scoring.decay(F.col("precipitation"), 5)).alias("decayed"),
        c.r6(F.abs(F.col("temp_min") - 20)).alias("distance"),
        c.r6(F.sqrt("wind_speed_max")).alias("root"),
        c.r6(F.pow("temp_max", 2)).alias("squared"),
        F.round(F.col("temp_max") * F.col("wind_gusts_max") / 7, 2).alias("rounded"),
        scoring.clip_score(F.col("temp_min"), 0.0, 30.0).alias("clipped"),
    )
