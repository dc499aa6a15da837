"""Ranking without unbounded groups against plain sorting."""

import random

from pyspark.sql import functions as F

from dayscout.operators import ranking
from dayscout.operators.aggregates import place_extremes


def brute(rows):
    out = {}
    for g in {r[0] for r in rows}:
        inside = sorted(
            (r for r in rows if r[0] == g),
            key=lambda r: (r[2] is None, -(r[2] or 0.0), r[1]),
        )
        out.update({(g, r[1]): i for i, r in enumerate(inside, 1)})
    return out


def test_rank_within_equals_sorting(spark):
    rng = random.Random(3)
    rows = [("hot", f"{rng.choice('abcdé')}{rng.choice('xyz')}{i:04d}", round(rng.random() * 3, 1))
            for i in range(3000)]
    rows += [(f"g{i % 50}", f"p{i}", float(i % 7)) for i in range(500)]
    rows += [("hot", "none-1", None), ("hot", "none-2", None)]
    df = spark.createDataFrame(rows, "g string, city string, score double")
    got = {(r["g"], r["city"]): r["rank"] for r in ranking.rank_within(df, ["g"], "score").collect()}
    assert got == brute(rows)


def test_rank_within_single_score(spark):
    rows = [("g", f"city{i:03d}", 5.0) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, city string, score double")
    got = ranking.rank_within(df, ["g"], "score").orderBy("rank").collect()
    assert [r["city"] for r in got] == sorted(r[1] for r in rows)
    assert [r["rank"] for r in got] == list(range(1, 201))


def test_one_score_and_one_prefix_are_many_tasks_work(spark):
    df = spark.range(20_000).selectExpr(
        "'g' AS g", "concat('Station_', lpad(id, 7, '0')) AS city", "100.0 AS score"
    )
    joined = "spark.sql.adaptive.coalescePartitions.enabled"  # so few rows would be one range
    spark.conf.set(joined, "false")
    try:
        out = ranking.rank_within(df, ["g"], "score")
        assert out.where("rank <> cast(substring(city, 9) AS int) + 1").count() == 0
        parts = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(joined)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 15_000


def test_top_k_prunes_before_the_exchange(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("city"), F.col("id").cast("int").alias("stars"),
        F.col("id").cast("string").alias("hotel_name"),
    )
    out = ranking.top_k(df, ["city"], ranking.by_stars(), 2)
    assert out.count() == 6
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_star_orders(spark):
    rows = [("a", None), ("b", 3), ("c", 5), ("d", None), ("e", 3)]
    df = spark.createDataFrame(rows, "hotel_name string, stars int")
    assert [r[0] for r in df.orderBy(*ranking.by_stars()).collect()] == ["c", "b", "e", "a", "d"]
    assert [r[0] for r in df.orderBy(*ranking.by_stars_zero()).collect()] == ["c", "b", "e", "a", "d"]


def test_ties_are_ordered_by_city(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "city string, s double")
    assert [r["city"] for r in ranking.top_n(df, ranking.by_score("s"), 3).collect()] == ["c", "a", "b"]


def test_equal_means_of_places_tie_by_name(spark):
    """Whatever the order in which a place's scores are added."""
    values = [52.53, 0.1, 0.2, 0.3, 99.99, 1e-2, 7.07]
    rows = [(f"p{i}", x) for i in range(8) for x in (values[i % 7 :] + values[: i % 7]) * 37]
    frame = spark.createDataFrame(rows, "city string, comfort_score double").repartition(5)
    found = [(r["side"], r["city"]) for r in place_extremes(frame).collect()]
    assert found == [(side, f"p{i}") for side in ("best", "worst") for i in range(3)]
