"""Radius join, staleness and enrichment."""

import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayscout.functions.geo import EARTH_RADIUS_M, Grid
from dayscout.operators import places as ops
from dayscout.plans import enrich
from dayscout.sources.dims import places

DAY = dt.date(2024, 3, 15)


def distance(a, b):
    (la, lo), (lb, lp) = a, b
    p, q = math.radians(la), math.radians(lb)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lp - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize(("radius", "crowded"), [(3_000.0, 1), (10_000.0, 7), (60_000.0, 10**5)])
def test_radius_join_equals_brute_force(spark, radius, crowded):
    rng = np.random.default_rng(1)
    centres = [("equator", 0.0, 0.01), ("dateline", 10.0, 179.99), ("north", 69.9, 20.0),
               ("south", -45.0, -179.97), ("mid", 48.85, 2.35), ("near", 48.86, 2.36),
               ("71", 71.0, 5.0), ("72", -72.0, 179.9), ("73", 73.0, -60.0), ("85", 85.0, 10.0),
               ("85s", -85.0, 100.0), ("89", 89.0, -179.99), ("89.9", 89.9, 40.0), ("89.9s", -89.9, 0.0),
               ("pole", 90.0, 12.0), ("south pole", -90.0, -77.0)]
    points = []
    for name, lat, lon in centres:
        for i in range(120):
            y = max(-90.0, min(90.0, lat + rng.normal(0, 0.12)))
            wide = 0.2 / max(math.cos(math.radians(lat)), 1e-3)
            x = (lon + rng.normal(0, wide) + 180) % 360 - 180
            points.append((f"{name}{i}", "hotel", float(y), float(x)))
    c = spark.createDataFrame(centres, "city string, latitude double, longitude double")
    p = spark.createDataFrame(points, "hotel_name string, hotel_type string, latitude double, longitude double")
    out = ops.radius_join(c, p, radius, crowded=crowded)
    got = sorted((r["place"], r["hotel_name"]) for r in out.collect())
    want = sorted(
        (n, q[0]) for n, la, lo in centres for q in points if distance((la, lo), q[2:]) <= radius
    )
    assert got == want and want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_half_of_all_points_in_one_cell(spark):
    """The crowd is dealt to many parts, and a small circle meets few of them."""
    rng = np.random.default_rng(3)
    town = [(f"t{i}", "hotel", 48.85 + float(y), 2.35 + float(x)) for i, (y, x) in enumerate(rng.uniform(-0.02, 0.02, (3000, 2)))]
    land = [(f"l{i}", "hotel", float(y), float(x)) for i, (y, x) in enumerate(rng.uniform((40, -5), (55, 15), (3000, 2)))]
    p = spark.createDataFrame(town + land, "hotel_name string, hotel_type string, latitude double, longitude double")
    centres = [("in", 48.851, 2.349), ("edge", 48.9, 2.41), ("far", 50.0, 8.0)]
    c = spark.createDataFrame(centres, "city string, latitude double, longitude double")
    got = sorted((r["place"], r["hotel_name"]) for r in ops.radius_join(c, p, 8_000.0, crowded=100).collect())
    want = sorted((n, q[0]) for n, y, x in centres for q in town + land if distance((y, x), q[2:]) <= 8_000.0)
    assert got == want and len(want) > 3000
    grid = Grid.for_radius(8_000.0)
    cells = p.withColumn("_cell", grid.cell(F.col("latitude"), F.col("longitude")))
    crowds = ops.crowded_cells(cells, grid, 100)
    placed = ops._split(cells, crowds).withColumn(
        "_part", grid.part(F.col("latitude"), F.col("longitude"), F.col("_cell"), F.col("_level"))
    )
    sizes = [r["count"] for r in placed.groupBy("_cell", "_part").count().collect()]
    assert crowds.count() < 10 and max(sizes) <= 100 and max(cells.groupBy("_cell").count().toPandas()["count"]) > 700


def test_lodging_types_are_a_parameter(spark):
    c = spark.createDataFrame([("a", 0.0, 0.0)], "city string, latitude double, longitude double")
    p = spark.createDataFrame(
        [("h", "hostel", 0.0, 0.0), ("m", "museum", 0.0, 0.0)],
        "hotel_name string, hotel_type string, latitude double, longitude double",
    )
    assert [r["hotel_name"] for r in ops.radius_join(c, p).collect()] == ["h"]
    assert ops.radius_join(c, p, types=["museum"]).first()["hotel_name"] == "m"


def test_a_pair_far_north(spark):
    c = spark.createDataFrame([("a", 85.0, 10.0)], "city string, latitude double, longitude double")
    p = spark.createDataFrame([("h", "hotel", 85.0, 10.9)], "hotel_name string, hotel_type string, latitude double, longitude double")
    assert ops.radius_join(c, p, 10_000.0).count() == 1
    with pytest.raises(ValueError):
        Grid.for_radius(0.0)


def test_a_radius_of_half_the_globe(spark):
    centres = spark.createDataFrame([("a", 10.0, 20.0)], "city string, latitude double, longitude double")
    points = [(str(i), "hotel", -90.0 + 9 * (i // 12), -180.0 + 30 * (i % 12)) for i in range(12 * 21)]
    p = spark.createDataFrame(points, "hotel_name string, hotel_type string, latitude double, longitude double")
    for radius in (5e6, 9.9e6, 1.9e7, 3e7):
        want = sorted(n for n, _, y, x in points if distance((10.0, 20.0), (y, x)) <= radius)
        assert sorted(r["hotel_name"] for r in ops.radius_join(centres, p, radius).collect()) == want


def recs(spark, scores, on=DAY):
    rows = [(on, city, profile, s) for city, profile, s in scores]
    return spark.createDataFrame(
        rows, "recommendation_date date, city string, profile_name string, comfort_score_pred double"
    )


def test_top_places_lists_each_place_once_from_the_newest_batch(spark):
    old = recs(spark, [("z", "leisure", 99.0)], DAY - dt.timedelta(days=1))
    new = recs(spark, [("a", "leisure", 80.0), ("a", "cyclist", 85.0), ("b", "leisure", 70.0)])
    got = ops.top_places(old.unionByName(new), 5).collect()
    assert [(r["city"], r["score"]) for r in got] == [("a", 85.0), ("b", 70.0)]


@pytest.mark.parametrize("fresh,expected", [(["a"], ["b", "c"]), (["a", "b", "c"], ["a", "b"]), ([], ["a", "b", "c"])])
def test_stale_places_with_fallback(spark, fresh, expected):
    top = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 1.0)], "city string, score double")
    rows = [(c, DAY - dt.timedelta(days=14)) for c in fresh] + [("c", DAY - dt.timedelta(days=15))]
    pois = spark.createDataFrame(rows, "city string, fetched_at date")
    got = sorted(r["city"] for r in ops.stale_places(top, pois, DAY).collect())
    assert got == expected


def test_enrich_parses_ranks_and_upserts(spark):
    centre = spark.createDataFrame([("a", 48.0, 2.0)], "city string, latitude double, longitude double")
    elements = []
    for i in range(15):
        tags = {"name": f"h{i:02d}", "tourism": "hotel"}
        if i % 3 == 0:
            tags["stars"] = str(1 + i % 5)
        elements.append((json.dumps({"type": "node", "lat": 48.0, "lon": 2.0 + i * 0.001, "tags": tags}),))
    elements.append((json.dumps({"type": "node", "lat": 49.0, "lon": 2.0, "tags": {"name": "far"}}),))
    elements.append((json.dumps({"type": "node", "lat": 48.0, "lon": 2.0, "tags": {"name": "h03", "stars": "9"}}),))
    raw = spark.createDataFrame(elements, "element string")
    columns = ("city string, hotel_name string, hotel_type string, stars int, address string,"
               "latitude double, longitude double, website_url string, amenities string,"
               "data_source string, fetched_at date")
    stored = spark.createDataFrame(
        [("a", "h00", "hostel", 1, None, 48.0, 2.0, None, None, None, DAY - dt.timedelta(days=90)),
         ("b", "other", "hotel", 1, None, 1.0, 1.0, None, None, None, DAY)], columns)
    state = enrich.enrich(recs(spark, [("a", "leisure", 80.0)]), centre, stored, raw, DAY)
    got = {(r["city"], r["hotel_name"]): r for r in state.collect()}
    assert len(got) == state.count()
    assert ("b", "other") in got and ("a", "far") not in got
    assert got[("a", "h00")]["hotel_type"] == "hotel" and got[("a", "h00")]["fetched_at"] == DAY
    assert got[("a", "h03")]["stars"] == 9


def test_default_places(spark):
    df = places(spark)
    assert df.count() == 20 and df.select("city").distinct().count() == 20
