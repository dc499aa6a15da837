"""Scans and sources."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check
from dayscout.operators.profiles import score_profiles
from dayscout.sources import scans
from dayscout.sources.dims import SEED_PROFILES, profiles_table
from dayscout.sources.forecast import corrupt_payloads, parse_forecasts
from dayscout.sources.poi_elements import parse_elements

_OBS5 = "city, date, temp_mean, precipitation, wind_speed_max"
_FEATS = (
    "city, feature_date, temp_mean_7d, temp_mean_3d, precip_sum_7d, precip_sum_3d,"
    " wind_max_7d, wind_max_3d, comfort_score"
)
_USABLE = "temp_mean_7d IS NOT NULL AND temp_mean_3d IS NOT NULL"


@check("scan_lookback", f"SELECT {_OBS5} FROM obs WHERE date >= (SELECT d FROM job_date) - 30 ORDER BY 1, 2")
def scan_lookback(spark, d):
    return scans.observations_lookback(c.obs(spark, d), c.as_of(spark, d)).orderBy("city", "date")


@check("scan_full_history", f"SELECT {_OBS5} FROM obs")
def scan_full_history(spark, d):
    return scans.observations_history(c.obs(spark, d))


@check(
    "scan_features_on_date",
    f"SELECT {_FEATS} FROM daily_features WHERE {_USABLE} ORDER BY city",
)
def scan_features_on_date(spark, d):
    return scans.features_on(c.daily_features(spark, d), c.as_of(spark, d)).orderBy("city")


@check(
    "scan_training_window",
    f"SELECT {_FEATS} FROM features WHERE {_USABLE} AND feature_date >= (SELECT d FROM job_date) - 90",
)
def scan_training_window(spark, d):
    return scans.features_window(c.features(spark, d), c.as_of(spark, d))


@check("scan_training_all", f"SELECT {_FEATS} FROM features WHERE {_USABLE}")
def scan_training_all(spark, d):
    return scans.features_all(c.features(spark, d))


@check(
    "parse_forecast_json",
    """SELECT city, date, temp_max, temp_min, (temp_max+temp_min)/2 AS temp_mean, precipitation,
       wind_speed_max, wind_gusts_max, weather_code FROM obs""",
)
def parse_forecast_json(spark, d):
    return parse_forecasts(c.payloads(spark, d))


@check(
    "corrupt_payload_count",
    """SELECT 2*count(*) AS payloads, count(*) AS corrupt
       FROM (SELECT DISTINCT city, date_trunc('month', date) FROM obs)""",
)
def corrupt_payload_count(spark, d):
    """Every payload once intact and once cut off."""
    whole = c.payloads(spark, d)
    cut = whole.withColumn("payload", F.expr("left(payload, length(payload) - 3)"))
    return corrupt_payloads(whole.unionByName(cut))


@check(
    "parse_poi_json",
    """SELECT city, hotel_name, hotel_type, stars, address, latitude, longitude, website_url,
       amenities, data_source FROM parsed_pois""",
)
def parse_poi_json(spark, d):
    return parse_elements(c.elements(spark, d))


@check("places_dim", "SELECT city, latitude, longitude FROM places")
def places_dim(spark, d):
    return c.places(spark, d)


@check(
    "profiles_dim",
    """SELECT q.profile_name, temp_weight, temp_ideal, temp_tolerance, rain_weight, rain_decay,
         rain_preference, wind_weight, wind_decay, wind_preference, count(s.city) AS n_scores
       FROM profiles q JOIN scores s ON s.profile_name = q.profile_name
       WHERE q.profile_name <> 'skier' GROUP BY ALL ORDER BY 1""",
)
def profiles_dim(spark, d):
    """The seeded profiles with how many scores each has."""
    n = score_profiles(c.features(spark, d)).groupBy("profile_name").agg(
        F.count("*").alias("n_scores")
    )
    params = profiles_table(spark, SEED_PROFILES).drop("description", "icon")
    return params.join(n, "profile_name").orderBy("profile_name")


@check(
    "scan_backfill_range",
    """SELECT city, date, temp_max, temp_min, temp_mean, precipitation, wind_speed_max,
       wind_gusts_max, weather_code FROM obs
       WHERE date BETWEEN (SELECT d FROM job_date) - 90 AND (SELECT d FROM job_date)""",
)
def scan_backfill_range(spark, d):
    end = F.lit(c.as_of(spark, d))
    return scans.observations_between(c.obs(spark, d), F.date_sub(end, 90), end)


@check(
    "sql_params",
    """SELECT city, count(*) AS n_days, max(temp_max) AS hottest FROM obs
       WHERE temp_max >= 30 AND date <= (SELECT d FROM job_date) - 30 GROUP BY city""",
)
def sql_params(spark, d):
    return scans.run_sql(
        spark,
        """SELECT city, count(*) AS n_days, max(temp_max) AS hottest FROM {obs}
           WHERE temp_max >= :low AND date <= date_sub(:as_of, 30) GROUP BY city""",
        {"low": 30.0, "as_of": c.as_of(spark, d)},
        obs=c.obs(spark, d),
    )


_COLUMNS = {
    ("raw_weather", "obs"): "city string, date date, temp_max double, temp_min double, temp_mean double, "
    "precipitation double, wind_speed_max double, wind_gusts_max double, weather_code int",
    ("weather_features", "features"): "city string, feature_date date, temp_mean_7d double, temp_mean_3d double, "
    "precip_sum_7d double, precip_sum_3d double, wind_max_7d double, wind_max_3d double, comfort_score double",
}


@check(
    "table_schema",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {i} AS ordinal, '{column.split()[0]}' AS column_name,"
        f" '{column.split()[1]}' AS data_type, count({column.split()[0]}) AS n_present FROM {view}"
        for (name, view), columns in _COLUMNS.items()
        for i, column in enumerate(columns.split(", "), 1)
    ),
)
def table_schema(spark, d):
    found = scans.describe_columns(spark, "raw_weather", c.obs(spark, d))
    return found.unionByName(scans.describe_columns(spark, "weather_features", c.features(spark, d)))
