"""Calendar windows over daily series, latest rows, and as-of carry forward.

A place's series is cut into blocks of ``BLOCK_DAYS`` days, so no window partition
ever holds more than one block however long or hot a series is. The few rows next to
a block border are copied into the following block, where later windows need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayscout.functions.scoring import comfort_score, nan_to_null
from dayscout.sources.scans import When, day

BLOCK_DAYS = 366
LONG_DAYS, SHORT_DAYS = 7, 3

# (output, input, aggregate, window length)
_ROLLING = [
    ("temp_mean_7d", "temp_mean", F.avg, LONG_DAYS),
    ("temp_mean_3d", "temp_mean", F.avg, SHORT_DAYS),
    ("precip_sum_7d", "precipitation", F.sum, LONG_DAYS),
    ("precip_sum_3d", "precipitation", F.sum, SHORT_DAYS),
    ("wind_max_7d", "wind_speed_max", F.max, LONG_DAYS),
    ("wind_max_3d", "wind_speed_max", F.max, SHORT_DAYS),
]
ROLLING_COLUMNS = [name for name, *_ in _ROLLING]


def _block(day_number: Column) -> Column:
    return F.floor(day_number / BLOCK_DAYS)


def _windowed(obs: DataFrame) -> DataFrame:
    """Rolling values per (city, date), with the block and the next date inside it.

    NaN counts as missing. RANGE frames on the day number, so date gaps count as missing days. One exchange
    and one sort on (city, block) serve all windows. Copied border rows come first in
    their block, so they never are anyone's next date; they are dropped afterwards.
    """
    number = F.unix_date("date")
    home, last_use = _block(number), _block(number + LONG_DAYS - 1)
    inputs = sorted({source for _, source, _, _ in _ROLLING})
    placed = obs.select(
        "city",
        "date",
        *[nan_to_null(F.col(c).cast("double")).alias(c) for c in inputs],
        number.alias("_day"),
        F.explode(
            F.when(home == last_use, F.array(home)).otherwise(F.array(home, last_use))
        ).alias("_block"),
    )
    series = Window.partitionBy("city", "_block").orderBy("_day")
    windows = [
        fn(source).over(series.rangeBetween(1 - length, 0)).alias(name)
        for name, source, fn, length in _ROLLING
    ]
    following = F.lead("date").over(series).alias("_inside")
    return placed.select("city", "date", "_day", "_block", following, *windows).where(
        _block(F.col("_day")) == F.col("_block")
    )


def rolling_raw(obs: DataFrame) -> DataFrame:
    """Per (city, date): means, sums and maxima over the last 7 and 3 calendar days."""
    return _windowed(obs).select("city", "date", *ROLLING_COLUMNS)


def _feature_columns(digits: int | None) -> list[Column]:
    """Stored columns: rounded windows, and the score of the unrounded 3-day values."""
    score = comfort_score(
        F.col("temp_mean_3d"), F.col("precip_sum_3d"), F.col("wind_max_3d"), digits=digits
    )
    stored = [
        (F.col(c) if digits is None else F.round(c, digits)).alias(c) for c in ROLLING_COLUMNS
    ]
    return [F.col("date").alias("feature_date"), *stored, score.alias("comfort_score")]


def rolling_features(obs: DataFrame, digits: int | None = 2) -> DataFrame:
    """One feature row per observation: six rolling values and the general score."""
    return rolling_raw(obs).select("city", *_feature_columns(digits))


def latest_per_place(features: DataFrame, as_of: When, anchor: str = "as_of") -> DataFrame:
    """The newest feature row of each place, relabelled with ``as_of``.

    ``anchor="as_of"`` ignores rows after that day, ``"latest"`` takes the last row
    there is (which may lie in the forecast). A partial ``max_by`` per map task keeps
    the exchange at one row per place and task.
    """
    if anchor not in ("as_of", "latest"):
        raise ValueError("anchor must be 'as_of' or 'latest'")
    rows = features
    if anchor == "as_of":
        rows = rows.where(F.col("feature_date") <= day(as_of))
    values = [c for c in features.columns if c not in ("city", "feature_date")]
    newest = F.max_by(F.struct("feature_date", *values), "feature_date")
    return (
        rows.groupBy("city")
        .agg(newest.alias("r"))
        .select(
            "city",
            day(as_of).alias("feature_date"),
            F.col("r.feature_date").alias("observed_date"),
            *[F.col(f"r.{c}").alias(c) for c in values],
        )
    )


def _with_next_date(blocked: DataFrame, seen: DataFrame) -> DataFrame:
    """Adds ``_next``: the place's next observed date, or NULL for its last one.

    Needs ``_block`` and ``_inside``, the next date within the block. For a block's last
    row it is the first date of the place's next non-empty block, from a table with
    one row per place and block.
    """
    firsts = (
        seen.groupBy("city", _block(F.unix_date("feature_date")).alias("_block"))
        .agg(F.min("feature_date").alias("_first"))
        .select(
            "city",
            "_block",
            F.lead("_first").over(Window.partitionBy("city").orderBy("_block")).alias("_later"),
        )
    )
    return (
        blocked.join(firsts, ["city", "_block"])
        .withColumn("_next", F.coalesce("_inside", "_later"))
        .drop("_block", "_inside", "_later")
    )


def _places_of_dates(seen: DataFrame) -> DataFrame:
    """(day, place): the distinct dates numbered from 0. The calendar bounds them: a
    hundred years are 36,525 rows, whatever the table holds."""
    days = seen.select(F.col("feature_date").alias("day")).distinct()
    return days.select("day", (F.row_number().over(Window.orderBy("day")) - 1).alias("place"))


def _covered(blocked: DataFrame, seen: DataFrame) -> DataFrame:
    """Each row once per place of a distinct date from its own to before the next row's:
    as many rows as the result has, however many calendar days lie between two dates."""
    places = _places_of_dates(seen)
    own = places.select(F.col("day").alias("feature_date"), F.col("place").alias("_from"))
    later = places.select(F.col("day").alias("_next"), F.col("place").alias("_to"))
    last = places.agg(F.max("place")).scalar()
    hidden = ("city", "feature_date", "_block", "_inside")
    values = [c for c in blocked.columns if c not in hidden]
    until = F.coalesce(F.col("_to") - 1, last)
    return (
        _with_next_date(blocked, seen)
        .join(own, "feature_date")
        .join(later, "_next", "left")
        .select(
            "city",
            F.explode(F.sequence("_from", until)).alias("place"),
            F.col("feature_date").alias("observed_date"),
            *values,
        )
    )


def _carried(blocked: DataFrame, seen: DataFrame) -> DataFrame:
    """Each row repeated on every distinct date up to the place's next row. ``seen``
    holds the (city, feature_date) keys.

    The as-of match is made in places of the distinct dates, not in calendar days: a row's
    date and the next one's give a range of places, and the places their dates back. All
    joins are equi-joins with the short list of dates; nothing is made and dropped."""
    covered = _covered(blocked, seen)
    values = [c for c in covered.columns if c not in ("city", "place", "observed_date")]
    dates = _places_of_dates(seen).withColumnRenamed("day", "feature_date")
    return covered.join(dates, "place").select("city", "feature_date", "observed_date", *values)


def carry_forward(features: DataFrame) -> DataFrame:
    """For every distinct date and every place already seen by then: the place's
    newest feature row at or before that date, stamped with the date."""
    inside = F.lead("feature_date").over(
        Window.partitionBy("city", "_block").orderBy("feature_date")
    )
    blocked = features.withColumn("_block", _block(F.unix_date("feature_date"))).withColumn(
        "_inside", inside
    )
    return _carried(blocked, features.select("city", "feature_date"))


def rolling_carried(obs: DataFrame, digits: int | None = 2) -> DataFrame:
    """``carry_forward(rolling_features(obs))`` in one pass: the next date comes from
    the windows' own exchange and sort."""
    blocked = _windowed(obs).select("city", "_block", "_inside", *_feature_columns(digits))
    return _carried(blocked, obs.select("city", F.col("date").alias("feature_date")))
