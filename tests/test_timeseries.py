"""Rolling windows and as-of carry forward against pandas."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from dayscout.operators import timeseries as ts
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES

OBS = "city string, date date, temp_mean double, precipitation double, wind_speed_max double"


def random_obs(days=900, keep=0.6, cities=3, seed=5):
    """Series with gaps and NULLs over several blocks."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(cities):
        for i in range(days):
            if rng.random() < keep and not 400 <= i < 400 + 40 * c:
                values = [float(v) for v in rng.integers(0, 60, 3)]
                values = [None if rng.random() < 0.2 else v for v in values]
                rows.append((f"c{c}", dt.date(2020, 1, 1) + dt.timedelta(days=i), *values))
    return rows


def expected_rolling(rows):
    df = pd.DataFrame(rows, columns=["city", "date", "temp_mean", "precipitation", "wind_speed_max"])
    df["date"] = pd.to_datetime(df["date"])
    out = {}
    for city, g in df.groupby("city"):
        g = g.set_index("date").sort_index().astype(
            {"temp_mean": float, "precipitation": float, "wind_speed_max": float}
        )
        for length, tag in ((7, "7d"), (3, "3d")):
            w = f"{length}D"
            for name, col, how in (
                (f"temp_mean_{tag}", "temp_mean", "mean"),
                (f"precip_sum_{tag}", "precipitation", "sum"),
                (f"wind_max_{tag}", "wind_speed_max", "max"),
            ):
                for d, v in getattr(g[col].rolling(w), how)().items():
                    out[(city, d.date(), name)] = None if pd.isna(v) else v
    return out


def test_rolling_equals_pandas_across_blocks_and_gaps(spark):
    rows = random_obs()
    got = ts.rolling_raw(spark.createDataFrame(rows, OBS)).collect()
    assert len(got) == len(rows)
    want = expected_rolling(rows)
    for r in got:
        for name in ts.ROLLING_COLUMNS:
            a, b = r[name], want[(r["city"], r["date"], name)]
            assert (a is None) == (b is None)
            assert a is None or abs(a - b) < 1e-9


def test_gap_and_null_windows(spark):
    base = dt.date(2024, 3, 1)
    rows = [
        ("x", base, 1.0, 1.0, 1.0),
        ("x", base + dt.timedelta(days=4), None, None, None),
        ("x", base + dt.timedelta(days=5), None, None, None),
        ("x", base + dt.timedelta(days=19), 4.0, 4.0, 4.0),
    ]
    got = ts.rolling_raw(spark.createDataFrame(rows, OBS)).orderBy("date").collect()
    for name in ("temp_mean_3d", "precip_sum_3d", "wind_max_3d"):
        assert [r[name] for r in got] == [1.0, None, None, 4.0]


def test_one_row_per_place_and_all_columns(spark):
    rows = [
        (c, dt.date(2024, 1, 1) + dt.timedelta(days=i), 15.0 + i, 5.0, 20.0)
        for c in ("Paris", "Nice") for i in range(10)
    ]
    as_of = dt.date(2024, 1, 12)
    out = ts.latest_per_place(ts.rolling_features(spark.createDataFrame(rows, OBS)), as_of)
    got = out.collect()
    assert {r["city"] for r in got} == {"Paris", "Nice"} and len(got) == 2
    assert all(r["feature_date"] == as_of for r in got)
    assert all(r["observed_date"] == dt.date(2024, 1, 10) for r in got)
    assert set(ts.ROLLING_COLUMNS) | {"comfort_score"} <= set(out.columns)


def test_constant_fortnight(spark):
    rows = [("Paris", dt.date(2024, 1, 1) + dt.timedelta(days=i), 15.0, 5.0, 20.0) for i in range(14)]
    features = ts.rolling_features(spark.createDataFrame(rows, OBS))
    r = ts.latest_per_place(features, dt.date(2024, 1, 14)).first()
    assert (r["temp_mean_7d"], r["precip_sum_7d"], r["precip_sum_3d"], r["wind_max_7d"]) == (
        15.0, 35.0, 15.0, 20.0,
    )


def test_anchor_decides_about_forecast_days(spark):
    rows = [("x", dt.date(2024, 1, i), float(i), 0.0, 0.0) for i in range(1, 11)]
    features = ts.rolling_features(spark.createDataFrame(rows, OBS))
    as_of = dt.date(2024, 1, 5)
    assert ts.latest_per_place(features, as_of).first()["temp_mean_3d"] == 4.0
    assert ts.latest_per_place(features, as_of, "latest").first()["temp_mean_3d"] == 9.0


def test_feature_lists():
    assert CLUSTER_FEATURES == ["temp_mean_7d", "precip_sum_7d", "wind_max_7d"]
    assert REGRESSION_FEATURES == ["temp_mean_3d", "precip_sum_3d", "wind_max_3d"]


def test_windows_share_one_exchange(spark):
    df = ts.rolling_features(spark.createDataFrame(random_obs(30), OBS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window [") == 1


def brute_carry(rows):
    dates = sorted({r[1] for r in rows})
    seen = {}
    for r in rows:
        seen.setdefault(r[0], []).append(r[1])
    return {
        (c, d, max(x for x in ds if x <= d))
        for c, ds in seen.items() for d in dates if min(ds) <= d
    }


def test_carry_forward_equals_brute_force(spark):
    rows = random_obs(days=800, keep=0.05)
    obs = spark.createDataFrame(rows, OBS)
    want = brute_carry(rows)
    for out in (ts.carry_forward(ts.rolling_features(obs)), ts.rolling_carried(obs)):
        got = [(r["city"], r["feature_date"], r["observed_date"]) for r in out.collect()]
        assert len(got) == len(want) and set(got) == want


def test_carried_values_are_those_of_the_observed_row(spark):
    obs = spark.createDataFrame(random_obs(days=100, keep=0.2), OBS)
    features = ts.rolling_features(obs)
    carried = ts.rolling_carried(obs)
    joined = carried.alias("k").join(
        features.alias("f"),
        (F.col("k.city") == F.col("f.city")) & (F.col("k.observed_date") == F.col("f.feature_date")),
    )
    same = F.col("k.comfort_score").eqNullSafe(F.col("f.comfort_score"))
    assert joined.where(~same).count() == 0 and joined.count() == carried.count()


def test_a_gap_of_a_century_makes_no_rows(spark):
    """Rows between the steps stay within those that come in and those that go out."""
    dates = [dt.date(1900, 1, 1), dt.date(1900, 1, 3)] + [dt.date(2000, 1, i) for i in range(1, 15)]
    rows = [("old", dates[0], 1.0), ("old", dates[-1], 2.0), ("mid", dates[1], 3.0)]
    rows += [("new", d, float(i)) for i, d in enumerate(dates[2:])]
    features = spark.createDataFrame(rows, "city string, feature_date date, v double")
    got = ts.carry_forward(features)
    want = []
    for city in {r[0] for r in rows}:
        for d in dates:
            seen = [r for r in rows if r[0] == city and r[1] <= d]
            if seen:
                last = max(seen, key=lambda r: r[1])
                want.append((city, d, last[1], last[2]))
    assert sorted(tuple(r) for r in got.select("city", "feature_date", "observed_date", "v").collect()) == sorted(want)
    blocked = features.withColumn("_block", ts._block(F.unix_date("feature_date"))).withColumn(
        "_inside", F.lead("feature_date").over(Window.partitionBy("city", "_block").orderBy("feature_date"))
    )
    seen = features.select("city", "feature_date")
    assert ts._covered(blocked, seen).count() == len(want)
    assert ts._places_of_dates(seen).count() == len(dates)
