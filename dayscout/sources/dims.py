"""Static dimensions: the place list and the preference profiles."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from dayscout.schemas import PLACES, PROFILES

# The default places (name, latitude, longitude).
DEFAULT_PLACES = [
    ("Lille", 50.6292, 3.0573),
    ("Rouen", 49.4432, 1.0993),
    ("Brest", 48.3905, -4.4860),
    ("Nantes", 47.2184, -1.5536),
    ("La Rochelle", 46.1591, -1.1520),
    ("Paris", 48.8566, 2.3522),
    ("Reims", 49.2583, 4.0317),
    ("Orléans", 47.9029, 1.9093),
    ("Strasbourg", 48.5734, 7.7521),
    ("Dijon", 47.3220, 5.0415),
    ("Lyon", 45.7640, 4.8357),
    ("Grenoble", 45.1885, 5.7245),
    ("Clermont-Ferrand", 45.7772, 3.0870),
    ("Bordeaux", 44.8378, -0.5792),
    ("Toulouse", 43.6047, 1.4442),
    ("Bayonne", 43.4929, -1.4748),
    ("Marseille", 43.2965, 5.3698),
    ("Montpellier", 43.6119, 3.8772),
    ("Nice", 43.7102, 7.2620),
    ("Ajaccio", 41.9192, 8.7386),
]


@dataclass(frozen=True)
class Profile:
    """Weights, ideals and preferences of one kind of trip."""

    profile_name: str
    temp_weight: float
    temp_ideal: float
    temp_tolerance: float
    rain_weight: float
    rain_decay: float
    rain_preference: str
    wind_weight: float
    wind_decay: float
    wind_preference: str
    icon: str | None = None
    description: str | None = None

    def __getitem__(self, name: str):
        return getattr(self, name)


# The seeded profiles.
SEED_PROFILES = [
    Profile("leisure", 50.0, 20.0, 6.0, 30.0, 5.0, "avoid", 20.0, 25.0, "avoid",
            "🏖️", "Mild, dry and calm days out."),
    Profile("wind_sports_enthusiast", 30.0, 18.0, 8.0, 10.0, 10.0, "neutral", 60.0, 15.0, "seek",
            "🏄", "Strong wind first, the rest hardly matters."),
    Profile("cyclist", 40.0, 18.0, 5.0, 40.0, 3.0, "avoid", 20.0, 20.0, "avoid",
            "🚴", "Dry roads, cool air, little wind."),
    Profile("stargazer", 20.0, 15.0, 10.0, 40.0, 3.0, "avoid", 40.0, 20.0, "avoid",
            "⭐", "Clear and steady air, any temperature."),
]
# A profile that is not seeded but covers rain seek and wind neutral.
SKIER = Profile("skier", 40.0, 0.0, 5.0, 30.0, 10.0, "seek", 30.0, 30.0, "neutral",
                "⛷️", "Cold with precipitation.")

DEFAULT_PROFILE = "leisure"


def places(spark: SparkSession, rows=DEFAULT_PLACES) -> DataFrame:
    return spark.createDataFrame(rows, PLACES.schema)


def profiles_table(spark: SparkSession, profiles: list[Profile] = SEED_PROFILES) -> DataFrame:
    """The profile parameters as a table, ordered by name."""
    names = [n for n in PROFILES.columns if n not in ("created_at", "updated_at")]
    rows = [tuple(asdict(p)[n] for n in names) for p in profiles]
    schema = PROFILES.schema.__class__([PROFILES.schema[n] for n in names])
    return spark.createDataFrame(rows, schema).orderBy("profile_name")
