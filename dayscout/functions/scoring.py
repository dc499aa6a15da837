"""Scores as Column expressions.

All scores take Columns and return a Column, so they stay inside whole-stage
codegen. ``digits=None`` returns the unrounded value.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# A profile parameter is either a plain value (folded at plan time) or a Column.
Param = float | Column


def missing(x: Column) -> Column:
    """NULL and NaN count as the same thing in every score."""
    return x.isNull() | F.isnan(x)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def midrange(high: Column, low: Column) -> Column:
    """Daily mean from the two extremes; NULL if either is NULL."""
    return (high + low) / 2


def _finish(score: Column, digits: int | None) -> Column:
    return score if digits is None else F.round(score, digits)


def bell(x: Column, centre: Param, width: Param) -> Column:
    z = (x - centre) / width
    return F.exp(-0.5 * z * z)


def decay(x: Column, scale: Param) -> Column:
    return F.exp(-x / scale)


def _or_half(x: Column, weight: Param, present: Column) -> Column:
    half = (weight if isinstance(weight, Column) else F.lit(float(weight))) * 0.5
    return F.when(missing(x), half).otherwise(present)


def comfort_score(
    temp: Column,
    rain: Column,
    wind: Column,
    *,
    temp_ideal: float = 20.0,
    temp_sigma: float = 6.0,
    rain_decay: float = 5.0,
    wind_decay: float = 25.0,
    digits: int | None = 2,
) -> Column:
    """General comfort score: 50 points temperature, 30 rain, 20 wind."""
    parts = [
        _or_half(temp, 50.0, 50.0 * bell(temp, temp_ideal, temp_sigma)),
        _or_half(rain, 30.0, 30.0 * decay(rain, rain_decay)),
        _or_half(wind, 20.0, 20.0 * decay(wind, wind_decay)),
    ]
    return _finish(reduce(add, parts), digits)


def _preference(x: Column, weight: Param, scale: Param, preference: str | Column) -> Column:
    """Score one exposure (rain or wind) under avoid / neutral / seek.

    A missing value scores half the weight whatever the preference; any text other
    than seek or neutral behaves as avoid.
    """
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    choices = {"seek": w * (1 - decay(x, scale)), "neutral": w * 0.7}
    avoid = w * decay(x, scale)
    if isinstance(preference, str):
        present = choices.get(preference, avoid)
    else:
        present = (
            F.when(preference == "seek", choices["seek"])
            .when(preference == "neutral", choices["neutral"])
            .otherwise(avoid)
        )
    return _or_half(x, weight, present)


def profile_score(
    temp: Column, rain: Column, wind: Column, profile, *, digits: int | None = 2
) -> Column:
    """Score under a profile: a mapping of parameter name to value or Column."""
    p = profile
    temp_part = _or_half(
        temp,
        p["temp_weight"],
        (p["temp_weight"] * bell(temp, p["temp_ideal"], p["temp_tolerance"])),
    )
    rain_part = _preference(rain, p["rain_weight"], p["rain_decay"], p["rain_preference"])
    wind_part = _preference(wind, p["wind_weight"], p["wind_decay"], p["wind_preference"])
    return _finish(temp_part + rain_part + wind_part, digits)


# The bands of the rule score. Each row is (upper bound, points) and
# the last points apply beyond the last bound.
RULE_RAIN_BANDS = [(1.0, 100.0), (5.0, 80.0), (15.0, 50.0)]
RULE_RAIN_BEYOND = 20.0
RULE_WIND_BANDS = [(15.0, 100.0), (25.0, 80.0), (35.0, 60.0)]
RULE_WIND_BEYOND = 30.0


def _banded(x: Column, bands: list[tuple[float, float]], beyond: float) -> Column:
    chain = F
    for bound, points in bands:
        chain = chain.when(x <= bound, points)
    return chain.otherwise(beyond)


def rule_temp_points(temp: Column) -> Column:
    return (
        F.when(temp.between(18, 25), 100.0)
        .when((temp >= 15) & (temp <= 28), 80.0)
        .when((temp >= 10) & (temp <= 32), 60.0)
        .otherwise(30.0)
    )


def rule_score(
    temp: Column, rain: Column, wind: Column, *, digits: int | None = 1
) -> Column:
    """Model-free banded score, weighted 0.5 / 0.3 / 0.2."""
    score = (
        0.5 * rule_temp_points(temp)
        + 0.3 * _banded(rain, RULE_RAIN_BANDS, RULE_RAIN_BEYOND)
        + 0.2 * _banded(wind, RULE_WIND_BANDS, RULE_WIND_BEYOND)
    )
    return _finish(score, digits)


def cluster_comfort_gauss(temp: Column, rain: Column, wind: Column) -> Column:
    """Smooth cluster score on cluster means."""
    return 50 * bell(temp, 18, 6) + 30 * decay(rain, 10) + 20 * decay(wind, 20)


def cluster_comfort_linear(temp: Column, rain: Column, wind: Column) -> Column:
    """Piecewise-linear cluster score on cluster means."""
    zero = F.lit(0.0)
    return (
        F.greatest(zero, 30 - rain)
        + F.greatest(zero, 20 - F.abs(temp - 18))
        + F.greatest(zero, 15 - wind / 3)
    )


def clip_score(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def absolute_error(predicted: Column, actual: Column) -> Column:
    return F.abs(predicted - actual)
