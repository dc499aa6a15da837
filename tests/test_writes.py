"""Writes as state changes; the store has tests of its own."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayscout.operators import writes
from dayscout.operators.timeseries import rolling_features
from dayscout.schemas import ALL_TABLES, FEATURES, OBSERVATIONS
from dayscout.sources import scans
from dayscout.sources.files import shared_dir

KV = "k string, v int, w int"


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_reduces_the_batch_by_explicit_order(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], KV)
    batch = spark.createDataFrame([("b", 5, 1), ("b", 9, 2), ("c", 7, 1)], KV)
    out = writes.upsert_replace(old, batch, ["k"], [F.col("w").desc()])
    assert pairs(out, "k", "v") == [("a", 1), ("b", 9), ("c", 7)]


def test_upsert_partial_keeps_other_columns(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], KV)
    batch = spark.createDataFrame([("b", None, 8), ("c", 7, 9)], KV)
    out = writes.upsert_partial(old, batch, ["k"], ["v"], [F.col("w")])
    assert sorted(out.collect(), key=lambda r: r["k"]) == [("a", 1, 1), ("b", None, 2), ("c", 7, 9)]


def test_insert_ignore(spark):
    old = spark.createDataFrame([("a", 1, 1)], KV)
    batch = spark.createDataFrame([("a", 9, 9), ("b", 2, 1), ("b", 3, 2)], KV)
    out = writes.insert_ignore(old, batch, ["k"], [F.col("w")])
    assert pairs(out, "k", "v") == [("a", 1), ("b", 2)]


def test_cascade_orphans_and_constraints(spark):
    children = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "p string, v int")
    parents = spark.createDataFrame([("a",)], "p string")
    assert pairs(writes.cascade_delete(children, parents, ["p"]), "v") == [(1,)]
    assert pairs(writes.orphans(children, parents, ["p"]), "v") == [(2,), (3,)]
    assert pairs(writes.duplicate_keys(children, ["p"]), "p", "n_rows") == [("b", 2)]
    with_null = children.unionByName(spark.createDataFrame([(None, 4)], "p string, v int"))
    assert writes.null_counts(with_null, ["p", "v"]).first().asDict() == {"p": 1, "v": 0}


def test_add_column_and_conform(spark):
    df = spark.createDataFrame([("a",)], "city string")
    assert writes.add_column(df, "profile_name", F.lit("leisure")).first()["profile_name"] == "leisure"
    half = spark.createDataFrame([("a", None), ("b", "x")], "city string, profile_name string")
    filled = writes.add_column(half, "profile_name", F.lit("leisure"))
    assert pairs(filled, "city", "profile_name") == [("a", "leisure"), ("b", "x")]
    with pytest.raises(ValueError):
        writes.conform(df, OBSERVATIONS)


def test_every_declared_key_is_a_column():
    for t in ALL_TABLES:
        assert set(t.key) <= set(t.columns)
        assert t.partition is None or t.partition in t.columns


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_sql_with_parameters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5)], "k string, v int")
    out = scans.run_sql(spark, "SELECT k FROM {t} WHERE v > :low", {"low": 3}, t=df)
    assert [r[0] for r in out.collect()] == ["b"]
    assert scans.has_column(df, "k") and not scans.has_column(df, "z")
    assert not scans.has_table(spark, "no_such_table")
    assert scans.declared_schema("weather_features") == FEATURES.schema


def test_missing_readings_are_no_numbers(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", day, 4.0, 1.0, 9.0), ("a", day + dt.timedelta(days=1), float("nan"), None, float("nan"))]
    obs = spark.createDataFrame(rows, "city string, date date, temp_mean double, precipitation double, wind_speed_max double")
    last = rolling_features(obs).orderBy("feature_date").collect()[-1]
    assert (last["temp_mean_3d"], last["precip_sum_3d"], last["wind_max_3d"]) == (4.0, 1.0, 9.0)
