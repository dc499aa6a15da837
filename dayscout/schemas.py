"""Explicit schemas, keys and layout of every table; nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "long": LongType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}


def _struct(spec: str) -> StructType:
    """Build a StructType from 'name type, name type!' where '!' means NOT NULL."""
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return StructType(fields)


@dataclass(frozen=True)
class Table:
    """A table's schema, its key (unique unless it is a log), the column whose ranges its
    files hold, and the tables its columns refer to by their keys."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    partition: str | None = None
    unique: bool = True
    parents: tuple[tuple[tuple[str, ...], Table], ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


OBSERVATIONS = Table(
    "raw_weather",
    _struct(
        "city string!, date date!, temp_max double, temp_min double, temp_mean double,"
        "precipitation double, wind_speed_max double, wind_gusts_max double,"
        "weather_code int, fetched_at timestamp"
    ),
    ("city", "date"),
    "date",
)

FEATURES = Table(
    "weather_features",
    _struct(
        "city string!, feature_date date!, temp_mean_7d double, temp_mean_3d double,"
        "precip_sum_7d double, precip_sum_3d double, wind_max_7d double, wind_max_3d double,"
        "comfort_score double, computed_at timestamp"
    ),
    ("city", "feature_date"),
    "feature_date",
)

PLACES = Table(
    "cities",
    _struct("city string!, latitude double!, longitude double!"),
    ("city",),
)

PROFILES = Table(
    "scoring_profiles",
    _struct(
        "profile_name string!, description string, icon string,"
        "temp_weight double!, temp_ideal double!, temp_tolerance double!,"
        "rain_weight double!, rain_decay double!, rain_preference string!,"
        "wind_weight double!, wind_decay double!, wind_preference string!,"
        "created_at timestamp, updated_at timestamp"
    ),
    ("profile_name",),
)

PROFILE_SCORES = Table(
    "profile_scores",
    _struct(
        "city string!, feature_date date!, profile_name string!,"
        "comfort_score double!, computed_at timestamp"
    ),
    ("city", "feature_date", "profile_name"),
    "feature_date",
    parents=((("profile_name",), PROFILES),),
)

RECOMMENDATIONS = Table(
    "recommendations",
    _struct(
        "recommendation_date date!, city string!, profile_name string!, cluster_id int,"
        "comfort_score_pred double, rank int, created_at timestamp"
    ),
    ("recommendation_date", "city", "profile_name"),
    "recommendation_date",
)

MODEL_RUNS = Table(
    "model_runs",
    _struct(
        "run_date date!, run_id long, model_type string!, metric_name string!, metric_value double,"
        "artifact_path string, is_champion boolean, created_at timestamp"
    ),
    ("model_type", "run_id"),
    unique=False,
)

POIS = Table(
    "hotels",
    _struct(
        "city string!, hotel_name string!, hotel_type string, stars int, address string,"
        "latitude double, longitude double, website_url string, amenities string,"
        "data_source string, fetched_at timestamp"
    ),
    ("city", "hotel_name"),
)

DRIFT_LOG = Table(
    "drift_monitoring",
    _struct(
        "check_timestamp timestamp, check_type string!, metric_name string!,"
        "metric_value double, baseline_value double, drift_score double,"
        "drift_detected boolean, threshold_used double, drift_severity string, metadata string"
    ),
    ("check_timestamp", "check_type", "metric_name"),
    unique=False,
)

ALL_TABLES = (
    OBSERVATIONS,
    FEATURES,
    PLACES,
    PROFILES,
    PROFILE_SCORES,
    RECOMMENDATIONS,
    MODEL_RUNS,
    POIS,
    DRIFT_LOG,
)

# Column groups used by the learning operators.
CLUSTER_FEATURES = ["temp_mean_7d", "precip_sum_7d", "wind_max_7d"]
REGRESSION_FEATURES = ["temp_mean_3d", "precip_sum_3d", "wind_max_3d"]
REGRESSION_TARGET = "comfort_score"
