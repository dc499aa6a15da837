"""Forecast payloads and map elements, with the unclean cases."""

import json

import pytest
from pyspark.sql import functions as F

from dayscout.functions import text
from dayscout.sources.forecast import corrupt_payloads, parse_forecasts
from dayscout.sources.poi_elements import parse_elements


def element(spark, **e):
    df = spark.createDataFrame([("x", json.dumps(e))], "city string, element string")
    return parse_elements(df).first()


def node(spark, **tags):
    return element(spark, type="node", lat=1.0, lon=2.0, tags={"name": "n", **tags})


@pytest.mark.parametrize(
    "tags,expected",
    [
        ({"stars": "4"}, 4),
        ({"stars": "4S"}, None),
        ({"stars": " 4 "}, 4),
        ({"stars": "7", "rating": "3"}, 3),
        ({"stars": "7"}, 7),
        ({"stars": "7", "star": "x", "rating": "0"}, 0),
        ({"star": "2", "rating": "5"}, 2),
        ({}, None),
    ],
)
def test_stars(spark, tags, expected):
    assert node(spark, **tags)["stars"] == expected


@pytest.mark.parametrize(
    "tags,expected",
    [
        ({"website": "  "}, ""),
        ({"website": "a.b"}, "https://a.b"),
        ({"website": "http://a.b"}, "http://a.b"),
        ({"website": "", "url": " https://c.d\n"}, "https://c.d"),
        ({"homepage": "e.f", "contact:website": "g.h"}, "https://g.h"),
        ({}, None),
    ],
)
def test_website(spark, tags, expected):
    assert node(spark, **tags)["website_url"] == expected


def test_address_amenities_and_defaults(spark):
    r = node(spark, **{
        "addr:street": "Rue A", "addr:housenumber": "", "addr:postcode": "75001",
        "internet_access": "yes", "wifi": "1", "spa": "no", "wheelchair": "true",
    })
    assert r["address"] == "Rue A, 75001"
    assert r["amenities"] == "wifi,wifi,accessible"
    assert r["hotel_type"] == "hotel" and r["data_source"] == "openstreetmap"
    empty = node(spark)
    assert empty["address"] is None and empty["amenities"] is None


def test_dropped_elements_and_coordinates(spark):
    assert element(spark, type="node", lat=1.0, lon=2.0, tags={"tourism": "hotel"}) is None
    assert element(spark, type="node", lat=1.0, lon=2.0, tags={"name": ""}) is None
    assert element(spark, type="way", lat=1.0, lon=2.0, tags={"name": "n"}) is None
    way = element(spark, type="way", center={"lat": 3.0, "lon": 4.0}, tags={"name": "n"})
    assert (way["latitude"], way["longitude"]) == (3.0, 4.0)


def payloads(spark, *texts):
    return spark.createDataFrame([("x", t) for t in texts], "city string, payload string")


def test_payload_rows(spark):
    daily = {
        "time": ["2024-01-01", "2024-01-02", "2024-01-03"],
        "temperature_2m_max": [10, "12.5", None],
        "temperature_2m_min": [0.0, "bad", 1.0],
        "wind_speed_10m_max": [5.5],
        "weather_code": [3.7, "3.7", " 61 "],
    }
    got = parse_forecasts(payloads(spark, json.dumps({"daily": daily}))).orderBy("date").collect()
    assert [str(r["date"]) for r in got] == daily["time"]
    assert [r["temp_max"] for r in got] == [10.0, 12.5, None]
    assert [r["temp_min"] for r in got] == [0.0, None, 1.0]
    assert [r["temp_mean"] for r in got] == [5.0, None, None]
    assert [r["precipitation"] for r in got] == [None] * 3
    assert [r["wind_speed_max"] for r in got] == [5.5, None, None]
    assert [r["weather_code"] for r in got] == [3, None, 61]


def test_payloads_without_rows(spark):
    bad = payloads(spark, '{"daily": {"time": []}}', "{}", '{"daily": {"time"', "not json")
    assert parse_forecasts(bad).count() == 0
    assert corrupt_payloads(bad).first().asDict() == {"payloads": 4, "corrupt": 2}


@pytest.mark.parametrize(
    "x,expected",
    [("1.5", 1.5), (" -2e1 ", -20.0), (".5", 0.5), ("1d", None), ("", None), ("nan", None), (None, None)],
)
def test_safe_float(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x string")
    assert df.select(text.safe_float(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize(
    "x,expected", [("4", 4), (" 4 ", 4), ("+4", 4), ("3.7", None), ("4S", None), ("99999999999", None)]
)
def test_safe_int(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x string")
    assert df.select(text.safe_int(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize("x,expected", [(3.7, 3), (-3.7, -3), (float("nan"), None), (1e12, None)])
def test_safe_int_number(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(text.safe_int_number(F.col("x"))).first()[0] == expected


def test_small_text_functions(spark):
    df = spark.createDataFrame([("*", "wIND sports", "wifi, pool ,bar")], "i string, n string, a string")
    label = df.select(text.capitalised_label(F.col("i"), F.col("n"))).first()[0]
    assert label == "* Wind sports"
    assert df.select(text.split_amenities(F.col("a"))).first()[0] == ["wifi", "pool", "bar"]
