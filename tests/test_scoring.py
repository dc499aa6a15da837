"""Scores against published anchors and their stated properties."""

import math

import pytest
from pyspark.sql import functions as F

from dayscout.functions import scoring
from dayscout.operators.profiles import score_profiles, with_default_score
from dayscout.operators.ranking import rank_clusters
from dayscout.sources.dims import SEED_PROFILES, SKIER, Profile, profiles_table

TRIPLE = "temp_mean_3d double, precip_sum_3d double, wind_max_3d double"


def comfort(spark, *triples, **kwargs):
    df = spark.createDataFrame([tuple(t) for t in triples], TRIPLE)
    cols = [F.col(c) for c in df.columns]
    return [r[0] for r in df.select(scoring.comfort_score(*cols, **kwargs)).collect()]


def part(x, weight, value):
    """Half the weight where the input is missing."""
    return weight / 2 if x is None or math.isnan(x) else weight * value(x)


def comfort_formula(t, r, w):
    return (
        part(t, 50, lambda x: math.exp(-(((x - 20) / 6) ** 2) / 2))
        + part(r, 30, lambda x: math.exp(-x / 5))
        + part(w, 20, lambda x: math.exp(-x / 25))
    )


GRID = [(t, r, w) for t in (-11.0, 3.5, 17.25, 23.0, 41.0, None) for r in (0.0, 0.75, 8.0, 63.0, math.nan)
        for w in (0.0, 12.5, 71.0, None)]


def test_comfort_is_its_formula(spark):
    got = comfort(spark, *GRID)
    assert got == pytest.approx([comfort_formula(*x) for x in GRID], abs=0.0051)
    assert all(x == round(x, 2) for x in got)


def test_comfort_is_symmetric_around_the_ideal_and_falls_with_rain_and_wind(spark):
    steps = [0.5 * i for i in range(1, 25)]
    warm = comfort(spark, *[(20 + s, 2.0, 9.0) for s in steps], digits=None)
    cool = comfort(spark, *[(20 - s, 2.0, 9.0) for s in steps], digits=None)
    assert warm == pytest.approx(cool) and warm == sorted(warm, reverse=True)
    for i in (1, 2):
        rows = [tuple(s if i == j else x for j, x in enumerate((16.0, 1.0, 4.0))) for s in steps]
        scores = comfort(spark, *rows, digits=None)
        assert scores == sorted(scores, reverse=True) and len(set(scores)) == len(steps)


def test_comfort_constants_are_parameters(spark):
    assert comfort(spark, (10.0, 0.0, 0.0), temp_ideal=10.0) == [100.0]


def scores_of(spark, triple, profiles):
    df = spark.createDataFrame([("x", *triple)], "city string, " + TRIPLE).withColumn(
        "feature_date", F.lit("2024-01-01").cast("date")
    )
    rows = score_profiles(df, profiles).collect()
    return {r["profile_name"]: r["comfort_score"] for r in rows}


def profile_formula(p, t, r, w):
    def exposure(x, weight, scale, preference):
        shapes = {"seek": lambda v: 1 - math.exp(-v / scale), "neutral": lambda v: 0.7}
        return part(x, weight, shapes.get(preference, lambda v: math.exp(-v / scale)))

    return (
        part(t, p.temp_weight, lambda v: math.exp(-(((v - p.temp_ideal) / p.temp_tolerance) ** 2) / 2))
        + exposure(r, p.rain_weight, p.rain_decay, p.rain_preference)
        + exposure(w, p.wind_weight, p.wind_decay, p.wind_preference)
    )


@pytest.mark.parametrize("triple", [(-6.5, 0.0, 3.0), (11.0, 2.25, 44.0), (29.5, 33.0, 8.5), (None, 4.0, None)])
def test_profiles_are_their_formula(spark, triple):
    everyone = [*SEED_PROFILES, SKIER]
    got = scores_of(spark, triple, everyone)
    assert got == pytest.approx({p.profile_name: profile_formula(p, *triple) for p in everyone}, abs=0.0051)


@pytest.mark.parametrize("column", [1, 2])
def test_preferences_turn_a_part_over(spark, column):
    """What avoiding loses by more rain or wind, seeking gains; neutral does not move."""
    kinds = ("avoid", "neutral", "seek")
    kind = lambda i, x: x if i == column else "avoid"
    profiles = [Profile(x, 40.0, 15.0, 7.0, 30.0, 8.0, kind(1, x), 30.0, 8.0, kind(2, x)) for x in kinds]
    low, high = (
        scores_of(spark, tuple(v if i == column else 9.0 for i in range(3)), profiles) for v in (2.0, 13.0)
    )
    change = {x: high[x] - low[x] for x in kinds}
    assert change["avoid"] < 0 and change["neutral"] == 0
    assert change["seek"] == pytest.approx(-change["avoid"], abs=0.021)


def test_unknown_preference_behaves_as_avoid(spark):
    a = Profile("a", 50.0, 20.0, 6.0, 30.0, 5.0, "avoid", 20.0, 25.0, "avoid")
    b = Profile("b", 50.0, 20.0, 6.0, 30.0, 5.0, "whatever", 20.0, 25.0, "none")
    got = scores_of(spark, (18.0, 3.0, 9.0), [a, b])
    assert got["a"] == got["b"]


def test_missing_input_scores_half_whatever_the_preference(spark):
    assert scores_of(spark, (None, None, math.nan), [SKIER])["skier"] == 50.0


def test_column_parameters_equal_literal_ones(spark):
    """A profile given as Columns (a joined table) scores like the folded literals."""
    df = spark.createDataFrame([(18.0, 5.0, 30.0)], TRIPLE)
    table = profiles_table(spark, [*SEED_PROFILES, SKIER])
    joined = table.join(df, F.lit(True))
    params = {c: F.col(c) for c in table.columns}
    score = scoring.profile_score(*[F.col(c) for c in df.columns], params)
    got = {r[0]: r[1] for r in joined.select("profile_name", score).collect()}
    assert got == scores_of(spark, (18.0, 5.0, 30.0), [*SEED_PROFILES, SKIER])


def test_scores_from_the_profile_table(spark):
    """The table scores like the objects, and two thousand profiles plan like two."""
    df = spark.createDataFrame(
        [(f"x{i}", *t) for i, t in enumerate([(18.0, 5.0, 30.0), (None, 0.5, 2.0)])], "city string, " + TRIPLE
    ).withColumn("feature_date", F.lit("2024-01-01").cast("date"))
    everyone = [*SEED_PROFILES, SKIER]
    rows = lambda out: sorted(map(tuple, out.collect()))
    table = profiles_table(spark, everyone)
    assert rows(score_profiles(df, table)) == rows(score_profiles(df, everyone))
    many = table.crossJoin(spark.range(400)).withColumn(
        "profile_name", F.concat_ws("-", "profile_name", "id")
    ).drop("id")
    plans = [
        score_profiles(df, t)._jdf.queryExecution().optimizedPlan().toString() for t in (table, many)
    ]
    assert score_profiles(df, many).count() == 2 * 2000
    assert plans[0].count("explode") == plans[1].count("explode") == 1


def test_default_score_is_zero_when_absent(spark):
    features = spark.createDataFrame(
        [("a", 1.0), ("b", 2.0)], "city string, comfort_score double"
    ).withColumn("feature_date", F.lit("2024-01-01").cast("date"))
    scores = spark.createDataFrame(
        [("a", "leisure", 70.0), ("b", "cyclist", 60.0)],
        "city string, profile_name string, comfort_score double",
    ).withColumn("feature_date", F.lit("2024-01-01").cast("date"))
    got = {r["city"]: r["comfort_score"] for r in with_default_score(features, scores).collect()}
    assert got == {"a": 70.0, "b": 0.0}


@pytest.mark.parametrize(
    "t,p,w,expected",
    [
        (20.0, 0.0, 10.0, 100.0),
        (15.0, 5.0, 25.0, 80.0),
        (28.0, 15.0, 35.0, 67.0),
        (32.0, 16.0, 36.0, 42.0),
        (9.9, 1.0, 15.0, 65.0),
    ],
)
def test_rule_score(spark, t, p, w, expected):
    df = spark.createDataFrame([(t, p, w)], "t double, p double, w double")
    assert df.select(scoring.rule_score(F.col("t"), F.col("p"), F.col("w"))).first()[0] == expected


def test_cluster_forms_disagree_on_the_second_cluster(spark):
    stats = spark.createDataFrame(
        [(0, 11.9, 9.0, 30.2), (1, 9.2, 22.5, 23.3), (2, 11.2, 19.3, 47.6), (3, 10.4, 69.2, 32.3)],
        "cluster_id int, avg_temp double, avg_precip double, avg_wind double",
    )
    expected = {
        "gauss": ([46.436, 26.456, 32.512, 26.424], [0, 2]),
        "linear": ([39.833, 25.933, 23.900, 16.633], [0, 1]),
    }
    for form, (values, best) in expected.items():
        rows = rank_clusters(stats, form).collect()
        by_id = sorted(rows, key=lambda r: r["cluster_id"])
        assert [round(r["cluster_comfort"], 3) for r in by_id] == values
        ranked = sorted(rows, key=lambda r: r["cluster_rank"])
        assert [r["cluster_id"] for r in ranked][:2] == best


def test_clip(spark):
    df = spark.createDataFrame([(-3.0,), (40.0,), (120.0,)], "x double")
    assert [r[0] for r in df.select(scoring.clip_score(F.col("x"))).collect()] == [0.0, 40.0, 100.0]
