"""Views over the driver tables, in Spark and in SQL, and the query registry.

Nations play the places, suppliers place the line items. The two forms of each view
are written independently: the Spark form uses the library, the SQL form is plain
ANSI SQL for the oracle.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayscout.operators.learning import nearest_centroid
from dayscout.operators.profiles import score_profiles
from dayscout.operators.runlog import flag_champions
from dayscout.operators.timeseries import latest_per_place, rolling_carried, rolling_features
from dayscout.plans.recommend import by_profiles, complete
from dayscout.schemas import CLUSTER_FEATURES, REGRESSION_FEATURES
from dayscout.sources.dims import SEED_PROFILES, SKIER

PROFILES = [*SEED_PROFILES, SKIER]
CENTROIDS = [(20.0, 10.0, 30.0), (25.0, 30.0, 45.0), (15.0, 20.0, 40.0), (22.0, 60.0, 48.0)]
# Literal coefficients of a linear score, standing in for a trained model in SQL.
LINEAR = (40.0, 1.5, -0.5, -0.2)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(key: str, sql: str | None = None):
    """Register a query under its key, with the oracle SQL if it is expressible."""

    def add(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return add


def r6(x) -> Column:
    """Six decimals. Means of two-decimal values can lie exactly halfway between two of
    them, where the order of a sum would decide; the nudge (also in the SQL) settles it."""
    return F.round((F.col(x) if isinstance(x, str) else x) + 1e-9, 6)


# --- Spark views -----------------------------------------------------------------


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def obs(spark: SparkSession, d: str) -> DataFrame:
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    items = table(spark, d, "lineitem").select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("date"),
        "l_quantity",
        "l_tax",
        "l_discount",
        "l_linenumber",
    )
    q = F.col("l_quantity")
    high, low = F.max(q) - 5, F.min(q) - 5
    return (
        items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("city"), "date")
        .agg(
            high.alias("temp_max"),
            low.alias("temp_min"),
            F.when(F.max("l_linenumber") != 1, (high + low) / 2).alias("temp_mean"),
            F.sum(F.round(F.col("l_tax") * 100)).alias("precipitation"),
            F.max(q).alias("wind_speed_max"),
            (F.max(q) + F.round(F.max("l_discount") * 100)).alias("wind_gusts_max"),
            (F.count("*") % 100).cast("int").alias("weather_code"),
        )
    )


def as_of(spark: SparkSession, d: str) -> dt.date:
    """The job date parameter: the newest day in the observations."""
    return table(spark, d, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]


def features(spark: SparkSession, d: str) -> DataFrame:
    return rolling_features(obs(spark, d))


def daily_features(spark: SparkSession, d: str) -> DataFrame:
    """Every place's newest features, carried to the job date."""
    return latest_per_place(features(spark, d), as_of(spark, d)).drop("observed_date")


def carried(spark: SparkSession, d: str) -> DataFrame:
    return rolling_carried(obs(spark, d)).drop("observed_date")


def scores(spark: SparkSession, d: str) -> DataFrame:
    return score_profiles(features(spark, d), PROFILES)


def assign(rows: DataFrame) -> DataFrame:
    return nearest_centroid(rows, CENTROIDS)


def clustered(spark: SparkSession, d: str) -> DataFrame:
    return assign(complete(features(spark, d), CLUSTER_FEATURES))


def linear_score(rows: DataFrame) -> DataFrame:
    a, t, p, w = LINEAR
    x, y, z = (F.col(c) for c in REGRESSION_FEATURES)
    return rows.withColumn("raw_prediction", a + t * x + p * y + w * z)


def recs_for(rows: DataFrame) -> DataFrame:
    usable = rows.where(F.col("temp_mean_7d").isNotNull() & F.col("temp_mean_3d").isNotNull())
    return by_profiles(usable, PROFILES, assign)


def recs_daily(spark: SparkSession, d: str) -> DataFrame:
    return recs_for(daily_features(spark, d))


def recs_all(spark: SparkSession, d: str) -> DataFrame:
    """Recommendations of every past date, from the carried features."""
    return recs_for(carried(spark, d))


def places(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_name").alias("city"),
        (41 + F.col("n_nationkey") * 0.5).alias("latitude"),
        (-5 + F.col("n_nationkey") * 0.5).alias("longitude"),
    )


def pois(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    stars = (key % 7).cast("int")
    kinds = F.array(*[F.lit(k) for k in ("hotel", "guest_house", "apartment", "hostel")])
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("city"),
        F.col("c_name").alias("hotel_name"),
        F.get(kinds, (key % 4).cast("int")).alias("hotel_type"),
        F.when(~stars.isin(0, 6), stars).alias("stars"),
        (41 + F.col("n_nationkey") * 0.5 + (key % 17 - 8) * 0.02).alias("latitude"),
        (-5 + F.col("n_nationkey") * 0.5 + (key % 13 - 6) * 0.02).alias("longitude"),
        F.when(key % 3 != 0, F.concat(F.lit("example.com/"), key)).alias("website_url"),
        F.when(key % 5 != 0, F.lit("wifi,parking")).alias("amenities"),
        F.date_sub(F.lit(dt.date(2001, 11, 4)), (key % 30).cast("int")).alias("fetched_at"),
    )


def elements(spark: SparkSession, d: str) -> DataFrame:
    """The points of interest as raw JSON elements with messy tags."""
    p = pois(spark, d)
    key = F.substring_index("hotel_name", "#", -1).cast("long")
    is_node = key % 2 == 0
    tags = F.map_filter(
        F.create_map(
            *[
                x
                for k, v in [
                    ("name", F.col("hotel_name")),
                    ("tourism", F.when(key % 4 != 0, F.col("hotel_type"))),
                    ("stars", F.when(key % 7 == 6, F.lit("4S")).when(key % 7 == 0, F.lit("7"))
                        .otherwise(F.col("stars").cast("string"))),
                    ("rating", F.when(key % 7 == 6, F.lit(" 3 "))),
                    ("addr:housenumber", F.when(key % 2 == 0, (key % 90).cast("string"))),
                    ("addr:street", F.when(key % 3 == 0, F.lit("High Street"))),
                    ("addr:city", F.when(key % 11 == 0, F.lit("")).otherwise(F.col("city"))),
                    ("website", F.when(key % 3 == 1, F.col("website_url"))
                        .when(key % 9 == 0, F.lit("  "))),
                    ("url", F.when(key % 3 == 2, F.concat(F.lit(" http://"), F.col("website_url")))),
                    ("internet_access", F.when(key % 2 == 0, F.lit("yes")).otherwise(F.lit("no"))),
                    ("wifi", F.when(key % 4 == 0, F.lit("1"))),
                    ("parking", F.when(key % 5 != 0, F.lit("true"))),
                    ("fitness_centre", F.when(key % 10 == 0, F.lit("yes"))),
                ]
                for x in (F.lit(k), v)
            ]
        ),
        lambda _k, v: v.isNotNull(),
    )
    lat, lon = F.col("latitude"), F.col("longitude")
    body = F.struct(
        F.when(is_node, F.lit("node")).otherwise(F.lit("way")).alias("type"),
        F.when(is_node, lat).alias("lat"),
        F.when(is_node, lon).alias("lon"),
        F.when(~is_node, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"),
        tags.alias("tags"),
    )
    return p.select("city", F.to_json(body).alias("element"))


def runs_plain(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    on = F.col("o_orderdate").cast("date")
    even = F.col("o_orderkey") % 2 == 0
    return o.select(
        on.alias("run_date"),
        on.alias("created_at"),
        F.col("o_orderkey").alias("run_id"),
        F.when(even, "kmeans").otherwise("regression").alias("model_type"),
        F.when(even, "silhouette_score").otherwise("test_r2").alias("metric_name"),
        ((F.floor("o_totalprice") % 1000) / 1000).alias("metric_value"),
    )


def runs(spark: SparkSession, d: str) -> DataFrame:
    return flag_champions(runs_plain(spark, d))


def payloads(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """Observations as forecast payloads, one JSON per place and month."""
    rows = obs(spark, d) if rows is None else rows
    names = [
        ("temperature_2m_max", "temp_max"),
        ("temperature_2m_min", "temp_min"),
        ("precipitation_sum", "precipitation"),
        ("wind_speed_10m_max", "wind_speed_max"),
        ("wind_gusts_10m_max", "wind_gusts_max"),
        ("weather_code", "weather_code"),
    ]
    days = F.array_sort(F.collect_list(F.struct("date", *[c for _, c in names])))
    daily = F.struct(
        F.transform("days", lambda x: x["date"].cast("string")).alias("time"),
        *[F.col("days")[c].alias(n) for n, c in names],
    )
    return (
        rows.groupBy("city", F.trunc("date", "month").alias("month"))
        .agg(days.alias("days"))
        .select("city", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))
    )


# --- SQL views -------------------------------------------------------------------


def comfort_sql(t: str, p: str, w: str) -> str:
    return (
        f"(CASE WHEN {t} IS NULL THEN 25 ELSE 50*exp(-0.5*(({t}-20)/6)*(({t}-20)/6)) END"
        f" + CASE WHEN {p} IS NULL THEN 15 ELSE 30*exp(-{p}/5) END"
        f" + CASE WHEN {w} IS NULL THEN 10 ELSE 20*exp(-{w}/25) END)"
    )


def _exposure_sql(x: str, kind: str) -> str:
    w, d, pref = f"q.{kind}_weight", f"q.{kind}_decay", f"q.{kind}_preference"
    return (
        f"CASE WHEN {x} IS NULL THEN {w}*0.5 WHEN {pref}='seek' THEN {w}*(1-exp(-{x}/{d}))"
        f" WHEN {pref}='neutral' THEN {w}*0.7 ELSE {w}*exp(-{x}/{d}) END"
    )


def profile_sql(t: str, p: str, w: str) -> str:
    """Profile score; the profile row is aliased q."""
    z = f"(({t}-q.temp_ideal)/q.temp_tolerance)"
    return (
        f"(CASE WHEN {t} IS NULL THEN q.temp_weight*0.5 ELSE q.temp_weight*exp(-0.5*{z}*{z}) END"
        f" + {_exposure_sql(p, 'rain')} + {_exposure_sql(w, 'wind')})"
    )


def _profile_rows() -> str:
    rows = []
    for q in PROFILES:
        rows.append(
            f"('{q.profile_name}', {q.temp_weight}::DOUBLE, {q.temp_ideal}::DOUBLE,"
            f" {q.temp_tolerance}::DOUBLE, {q.rain_weight}::DOUBLE, {q.rain_decay}::DOUBLE,"
            f" '{q.rain_preference}', {q.wind_weight}::DOUBLE, {q.wind_decay}::DOUBLE,"
            f" '{q.wind_preference}', '{q.icon}')"
        )
    return ", ".join(rows)


def _centroid_sql(alias: str = "") -> str:
    t, p, w = (f"{alias}{c}" for c in CLUSTER_FEATURES)
    d = [
        f"(({t}-{a})*({t}-{a})+({p}-{b})*({p}-{b})+({w}-{c})*({w}-{c}))" for a, b, c in CENTROIDS
    ]
    least = f"least({', '.join(d)})"
    cases = " ".join(f"WHEN {x} = {least} THEN {i}" for i, x in enumerate(d))
    return f"CAST(CASE {cases} END AS INTEGER)"


_FEATURE_COLUMNS = (
    "temp_mean_7d, temp_mean_3d, precip_sum_7d, precip_sum_3d, wind_max_7d, wind_max_3d"
)


def _recs_sql(rows: str) -> str:
    """Recommendations from a view of feature rows, for all dates in it."""
    return f"""
    WITH usable AS (
      SELECT *, {_centroid_sql()} AS cluster_id FROM {rows}
      WHERE temp_mean_7d IS NOT NULL AND temp_mean_3d IS NOT NULL
        AND precip_sum_7d IS NOT NULL AND wind_max_7d IS NOT NULL),
    st AS (SELECT feature_date, cluster_id, avg(temp_mean_7d) t, avg(precip_sum_7d) p,
                  avg(wind_max_7d) w FROM usable GROUP BY 1, 2),
    rk AS (SELECT feature_date, cluster_id, row_number() OVER (PARTITION BY feature_date ORDER BY
             50*exp(-0.5*((t-18)/6)*((t-18)/6)) + 30*exp(-p/10) + 20*exp(-w/20) DESC, cluster_id) r
           FROM st),
    sc AS (SELECT u.feature_date, u.city, q.profile_name, u.cluster_id,
             round({profile_sql('u.temp_mean_3d', 'u.precip_sum_3d', 'u.wind_max_3d')}, 2) s
           FROM usable u JOIN rk USING (feature_date, cluster_id) CROSS JOIN profiles q
           WHERE rk.r <= 2)
    SELECT feature_date AS recommendation_date, city, profile_name, cluster_id,
      s AS comfort_score_pred,
      CAST(row_number() OVER (PARTITION BY feature_date, profile_name ORDER BY s DESC, city)
           AS INTEGER) AS rank
    FROM sc"""


VIEWS: dict[str, str] = {
    "obs": """
    SELECT n_name AS city, CAST(l_shipdate AS DATE) AS date,
      max(l_quantity)-5 AS temp_max, min(l_quantity)-5 AS temp_min,
      CASE WHEN max(l_linenumber)=1 THEN NULL
           ELSE (max(l_quantity)-5+min(l_quantity)-5)/2 END AS temp_mean,
      sum(round(l_tax*100)) AS precipitation, max(l_quantity) AS wind_speed_max,
      max(l_quantity)+round(max(l_discount)*100) AS wind_gusts_max,
      CAST(count(*)%100 AS INTEGER) AS weather_code
    FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey
    GROUP BY 1, 2""",
    "job_date": "SELECT max(date) AS d FROM obs",
    "raw_features": """
    SELECT city, date AS feature_date,
      avg(temp_mean) OVER w7 AS temp_mean_7d, avg(temp_mean) OVER w3 AS temp_mean_3d,
      sum(precipitation) OVER w7 AS precip_sum_7d, sum(precipitation) OVER w3 AS precip_sum_3d,
      max(wind_speed_max) OVER w7 AS wind_max_7d, max(wind_speed_max) OVER w3 AS wind_max_3d
    FROM obs
    WINDOW w7 AS (PARTITION BY city ORDER BY date
                  RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
           w3 AS (PARTITION BY city ORDER BY date
                  RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW)""",
    "features": f"""
    SELECT city, feature_date,
      round(temp_mean_7d, 2) AS temp_mean_7d, round(temp_mean_3d, 2) AS temp_mean_3d,
      round(precip_sum_7d, 2) AS precip_sum_7d, round(precip_sum_3d, 2) AS precip_sum_3d,
      round(wind_max_7d, 2) AS wind_max_7d, round(wind_max_3d, 2) AS wind_max_3d,
      round({comfort_sql('temp_mean_3d', 'precip_sum_3d', 'wind_max_3d')}, 2) AS comfort_score
    FROM raw_features""",
    "profiles": f"""
    SELECT * FROM (VALUES {_profile_rows()}) AS t(profile_name, temp_weight, temp_ideal,
      temp_tolerance, rain_weight, rain_decay, rain_preference, wind_weight, wind_decay,
      wind_preference, icon)""",
    "scores": f"""
    SELECT f.city, f.feature_date, q.profile_name,
      round({profile_sql('f.temp_mean_3d', 'f.precip_sum_3d', 'f.wind_max_3d')}, 2) AS comfort_score
    FROM features f CROSS JOIN profiles q""",
    "daily_features": f"""
    SELECT f.city, (SELECT d FROM job_date) AS feature_date, {_FEATURE_COLUMNS}, comfort_score
    FROM features f JOIN (SELECT city, max(feature_date) m FROM features
      WHERE feature_date <= (SELECT d FROM job_date) GROUP BY 1) x
      ON f.city = x.city AND f.feature_date = x.m""",
    "carried": f"""
    SELECT k.city, k.d AS feature_date, f.feature_date AS observed_date, {_FEATURE_COLUMNS},
           comfort_score
    FROM (SELECT c.city, t.d FROM (SELECT DISTINCT city FROM features) c
          CROSS JOIN (SELECT DISTINCT feature_date AS d FROM features) t) k
    ASOF JOIN features f ON k.city = f.city AND k.d >= f.feature_date""",
    "clustered": f"""
    SELECT *, {_centroid_sql()} AS cluster_id FROM features
    WHERE temp_mean_7d IS NOT NULL AND precip_sum_7d IS NOT NULL AND wind_max_7d IS NOT NULL""",
    "recs_daily": _recs_sql("daily_features"),
    "recs_all": _recs_sql("carried"),
    "places": """
    SELECT n_name AS city, CAST(41+n_nationkey*0.5 AS DOUBLE) AS latitude,
           CAST(-5+n_nationkey*0.5 AS DOUBLE) AS longitude FROM nation""",
    "pois": """
    SELECT n_name AS city, c_name AS hotel_name,
      CASE c_custkey%4 WHEN 0 THEN 'hotel' WHEN 1 THEN 'guest_house' WHEN 2 THEN 'apartment'
           ELSE 'hostel' END AS hotel_type,
      CASE WHEN c_custkey%7 IN (0, 6) THEN NULL ELSE CAST(c_custkey%7 AS INTEGER) END AS stars,
      41+n_nationkey*0.5::DOUBLE+(c_custkey%17-8)*0.02::DOUBLE AS latitude,
      -5+n_nationkey*0.5::DOUBLE+(c_custkey%13-6)*0.02::DOUBLE AS longitude,
      CASE WHEN c_custkey%3=0 THEN NULL ELSE 'example.com/'||c_custkey END AS website_url,
      CASE WHEN c_custkey%5=0 THEN NULL ELSE 'wifi,parking' END AS amenities,
      DATE '2001-11-04' - CAST(c_custkey%30 AS INTEGER) AS fetched_at, c_custkey
    FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "parsed_pois": """
    SELECT city, hotel_name, CASE WHEN c_custkey%4=0 THEN 'hotel' ELSE hotel_type END AS hotel_type,
      CAST(CASE c_custkey%7 WHEN 6 THEN 3 WHEN 0 THEN 7 ELSE stars END AS INTEGER) AS stars,
      nullif(concat_ws(', ', CASE WHEN c_custkey%2=0 THEN CAST(c_custkey%90 AS VARCHAR) END,
        CASE WHEN c_custkey%3=0 THEN 'High Street' END,
        CASE WHEN c_custkey%11<>0 THEN city END), '') AS address,
      latitude, longitude,
      CASE c_custkey%3 WHEN 1 THEN 'https://'||website_url WHEN 2 THEN 'http://'||website_url
           ELSE CASE WHEN c_custkey%9=0 THEN '' END END AS website_url,
      nullif(concat_ws(',', CASE WHEN c_custkey%2=0 THEN 'wifi' END,
        CASE WHEN c_custkey%4=0 THEN 'wifi' END, CASE WHEN c_custkey%5<>0 THEN 'parking' END,
        CASE WHEN c_custkey%10=0 THEN 'gym' END), '') AS amenities,
      'openstreetmap' AS data_source, c_custkey
    FROM pois""",
    "runs_plain": """
    SELECT CAST(o_orderdate AS DATE) AS run_date, CAST(o_orderdate AS DATE) AS created_at,
      o_orderkey AS run_id,
      CASE WHEN o_orderkey%2=0 THEN 'kmeans' ELSE 'regression' END AS model_type,
      CASE WHEN o_orderkey%2=0 THEN 'silhouette_score' ELSE 'test_r2' END AS metric_name,
      (CAST(floor(o_totalprice) AS BIGINT)%1000)/1000 AS metric_value
    FROM orders""",
    # One recursion step per promotion: the next run that beats the champion.
    "promotions": """
    WITH RECURSIVE ordered AS (
      SELECT model_type, metric_value, run_id, created_at,
        row_number() OVER (PARTITION BY model_type ORDER BY created_at, run_id) AS n,
        CASE model_type WHEN 'kmeans' THEN 0.05::DOUBLE ELSE 0.01::DOUBLE END AS delta
      FROM runs_plain),
    chain AS (
      SELECT model_type, 1 AS sequence, n, metric_value, run_id, created_at FROM ordered WHERE n = 1
      UNION ALL
      SELECT c.model_type, c.sequence+1, o.n, o.metric_value, o.run_id, o.created_at
      FROM chain c, LATERAL (SELECT * FROM ordered o WHERE o.model_type = c.model_type AND o.n > c.n
        AND o.metric_value > c.metric_value + o.delta ORDER BY o.n LIMIT 1) o)
    SELECT model_type, sequence, created_at, run_id, metric_value,
      lead(run_id) OVER (PARTITION BY model_type ORDER BY sequence) AS replaced_by,
      lead(run_id) OVER (PARTITION BY model_type ORDER BY sequence) IS NULL AS is_champion
    FROM chain""",
    "runs": """
    SELECT r.*, coalesce(p.is_champion, FALSE) AS is_champion FROM runs_plain r
    LEFT JOIN promotions p ON p.model_type = r.model_type AND p.run_id = r.run_id""",
}


def with_views(sql: str) -> str:
    """Prefix the SQL with the views it refers to, directly or through other views."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        words = set(re.findall(r"\b[a-z_0-9]+\b", text))
        for name, body in VIEWS.items():
            if name in words and name not in needed:
                visit_body = re.sub(rf"\b{name}\b", "", body)
                visit(visit_body)
                needed[name] = None

    visit(sql)
    if not needed:
        return sql.strip()
    parts = [f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in needed]
    body = sql.strip()
    recursive = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE") else ""
    if body.upper().startswith("WITH "):
        body = re.sub(r"^WITH\s+(RECURSIVE\s+)?", "", body, flags=re.I)
        return f"WITH {recursive}{', '.join(parts)}, {body}"
    return f"WITH {', '.join(parts)} {body}"
