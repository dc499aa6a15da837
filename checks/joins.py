"""Joins and set operations."""

from pyspark.sql import functions as F

from checks import common as c
from checks.common import check
from dayscout.functions.geo import haversine
from dayscout.operators import places as ops
from dayscout.operators.aggregates import cluster_stats
from dayscout.operators.profiles import join_scores, with_default_score
from dayscout.operators.ranking import keep_good_clusters, rank_clusters
from dayscout.operators.timeseries import carry_forward


@check("cross_profiles", "SELECT city, feature_date, profile_name, comfort_score FROM scores")
def cross_profiles(spark, d):
    return c.scores(spark, d)


@check(
    "left_join_scores",
    """SELECT f.city, f.feature_date, f.comfort_score, s.profile_name,
         s.comfort_score AS comfort_score_profile
       FROM carried f LEFT JOIN scores s ON f.city = s.city AND f.feature_date = s.feature_date""",
)
def left_join_scores(spark, d):
    """Carried rows have scores only on days with an observation, so the left side shows."""
    joined = join_scores(c.carried(spark, d), c.scores(spark, d))
    return joined.select(
        "city", "feature_date", "comfort_score", "profile_name", "comfort_score_profile"
    )


@check(
    "join_rec_place_score",
    """SELECT r.recommendation_date, r.profile_name, r.city, r.rank, r.comfort_score_pred,
         r.cluster_id, p.latitude, p.longitude, s.comfort_score AS actual_score
       FROM recs_all r JOIN places p ON r.city = p.city LEFT JOIN scores s
         ON r.city = s.city AND r.recommendation_date = s.feature_date
         AND r.profile_name = s.profile_name WHERE r.rank <= 10""",
)
def join_rec_place_score(spark, d):
    recs = c.recs_all(spark, d).where(F.col("rank") <= 10)
    joined = ops.recommendations_with_places(recs, c.places(spark, d), c.scores(spark, d))
    return joined.select(
        "recommendation_date", "profile_name", "city", "rank", "comfort_score_pred",
        "cluster_id", "latitude", "longitude", "actual_score",
    )


@check(
    "left_join_weather",
    """SELECT r.recommendation_date, r.profile_name, r.city, r.rank, f.temp_mean_3d,
         f.precip_sum_3d, f.wind_max_3d
       FROM recs_all r LEFT JOIN features f ON r.rank <= 5 AND f.city = r.city
         AND f.feature_date = r.recommendation_date""",
)
def left_join_weather(spark, d):
    joined = ops.with_weather_for_top(c.recs_all(spark, d), c.features(spark, d), 5)
    return joined.select(
        "recommendation_date", "profile_name", "city", "rank", "temp_mean_3d",
        "precip_sum_3d", "wind_max_3d",
    )


_TOP_POIS = """SELECT city, hotel_name, stars, CAST(row_number() OVER (PARTITION BY city
  ORDER BY stars DESC NULLS LAST, hotel_name) AS INTEGER) AS poi_rank FROM pois"""


@check(
    "join_topk_pois",
    f"""SELECT * FROM ({_TOP_POIS} WHERE city IN (SELECT city FROM recs_daily))
        WHERE poi_rank <= 5""",
)
def join_topk_pois(spark, d):
    found = ops.top_pois(c.recs_daily(spark, d), c.pois(spark, d), 5)
    return found.select("city", "hotel_name", "stars", "poi_rank")


TOP_SQL = """top AS (SELECT city, max(comfort_score_pred) AS score FROM recs_daily
  WHERE recommendation_date = (SELECT max(recommendation_date) FROM recs_daily)
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)"""
STALE_SQL = f"""{TOP_SQL},
stale AS (SELECT * FROM top WHERE city NOT IN
  (SELECT city FROM pois WHERE fetched_at >= (SELECT d FROM job_date) - 14)),
chosen AS (SELECT * FROM stale UNION ALL SELECT * FROM
  (SELECT * FROM top WHERE NOT EXISTS (SELECT 1 FROM stale) ORDER BY score DESC, city LIMIT 2))"""


def top(spark, d):
    return ops.top_places(c.recs_daily(spark, d), 5)


@check("anti_join_stale", f"WITH {STALE_SQL} SELECT city, score FROM chosen")
def anti_join_stale(spark, d):
    return ops.stale_places(top(spark, d), c.pois(spark, d), c.as_of(spark, d))


@check(
    "asof_carry_forward",
    """SELECT city, feature_date, observed_date, temp_mean_7d, temp_mean_3d, precip_sum_7d,
         precip_sum_3d, wind_max_7d, wind_max_3d, comfort_score FROM carried""",
)
def asof_carry_forward(spark, d):
    return carry_forward(c.features(spark, d))


def _haversine_sql(lat1, lon1, lat2, lon2):
    return (
        f"2*6371000*asin(sqrt(least(1.0, pow(sin(radians({lat2}-{lat1})/2), 2)"
        f" + cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2), 2))))"
    )


DISTANCE_SQL = _haversine_sql("p.latitude", "p.longitude", "h.latitude", "h.longitude")


@check(
    "radius_join",
    f"""SELECT p.city AS place, h.city, h.hotel_name, round({DISTANCE_SQL}, 3) AS distance_m
        FROM places p JOIN pois h ON {DISTANCE_SQL} <= 10000""",
)
def radius_join(spark, d):
    found = ops.radius_join(c.places(spark, d), c.pois(spark, d), 10_000.0)
    return found.select(
        "place", "city", "hotel_name", F.round("distance_m", 3).alias("distance_m")
    )


@check(
    "lookup_default",
    """SELECT f.city, f.feature_date, coalesce(s.comfort_score, 0) AS comfort_score
       FROM carried f LEFT JOIN scores s ON f.city = s.city AND f.feature_date = s.feature_date
         AND s.profile_name = 'leisure'""",
)
def lookup_default(spark, d):
    joined = with_default_score(c.carried(spark, d), c.scores(spark, d))
    return joined.select("city", "feature_date", "comfort_score")


@check(
    "semi_good_clusters",
    """WITH st AS (SELECT feature_date, cluster_id, avg(temp_mean_7d) t, avg(precip_sum_7d) p,
         avg(wind_max_7d) w FROM clustered GROUP BY 1, 2),
       rk AS (SELECT *, row_number() OVER (PARTITION BY feature_date ORDER BY
         greatest(0, 30-p)+greatest(0, 20-abs(t-18))+greatest(0, 15-w/3) DESC, cluster_id) AS r
         FROM st)
       SELECT city, feature_date, cluster_id FROM clustered SEMI JOIN
         (SELECT * FROM rk WHERE r <= 2) g USING (feature_date, cluster_id)""",
)
def semi_good_clusters(spark, d):
    rows = c.clustered(spark, d)
    ranked = rank_clusters(cluster_stats(rows, ["feature_date"]), "linear", ["feature_date"])
    kept = keep_good_clusters(rows, ranked, 2, ["feature_date"])
    return kept.select("city", "feature_date", "cluster_id")


@check(
    "scalar_subquery_latest",
    """SELECT city, max(comfort_score_pred) AS score FROM recs_all
       WHERE recommendation_date = (SELECT max(recommendation_date) FROM recs_all)
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
)
def scalar_subquery_latest(spark, d):
    return ops.top_places(c.recs_all(spark, d), 3)


@check("assign_labels", "SELECT city, feature_date, cluster_id FROM clustered")
def assign_labels(spark, d):
    return c.clustered(spark, d).select("city", "feature_date", "cluster_id")


@check(
    "union_all_batches",
    """SELECT city, feature_date, profile_name, comfort_score FROM scores
       UNION ALL SELECT city, feature_date, 'general', comfort_score FROM features""",
)
def union_all_batches(spark, d):
    general = c.features(spark, d).select(
        "city", "feature_date", F.lit("general").alias("profile_name"), "comfort_score"
    )
    return c.scores(spark, d).unionByName(general)


@check(
    "set_difference_places",
    """SELECT city FROM (SELECT city FROM places UNION ALL SELECT city||' (new)' FROM places)
       EXCEPT SELECT city FROM pois""",
)
def set_difference_places(spark, d):
    """All places, and a new one beside each, minus those with any lodging."""
    places = c.places(spark, d)
    new = places.withColumn("city", F.concat("city", F.lit(" (new)")))
    return ops.set_difference(places.unionByName(new), c.pois(spark, d))


@check(
    "haversine",
    f"""SELECT p.city, h.hotel_name, round({DISTANCE_SQL}, 3) AS distance_m
        FROM pois h JOIN places p ON p.city = h.city""",
)
def haversine_to_centre(spark, d):
    centre = c.places(spark, d).select(
        "city", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    )
    distance = haversine(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude"))
    return c.pois(spark, d).join(centre, "city").select(
        "city", "hotel_name", F.round(distance, 3).alias("distance_m")
    )
