"""Drift statistics and reports."""

import datetime as dt
import itertools
import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayscout.functions import drift_rules as rules
from dayscout.operators import ks
from dayscout.operators.ks import ks_two_sample
from dayscout.plans import drift

DAY = dt.date(2024, 3, 1)


def numpy_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    every = np.concatenate([a, b])
    fa = np.searchsorted(a, every, side="right") / len(a)
    fb = np.searchsorted(b, every, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def spark_ks(spark, a, b, **kwargs):
    rows = [("m", float(x), False) for x in a] + [("m", float(x), True) for x in b]
    df = spark.createDataFrame(rows, "g string, v double, cur boolean")
    return ks_two_sample(df, ["g"], "v", "cur", **kwargs).first()


@pytest.fixture
def rng():
    return np.random.default_rng(2024)


@pytest.mark.parametrize("digits", [None, 2, 0])
@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e12])
@pytest.mark.parametrize("bands", [1, 3, 32])
def test_ks_equals_numpy(spark, rng, digits, scale, bands):
    a, b = rng.gamma(2.0, 4.0, 230), rng.gamma(3.0, 3.0, 140)
    if digits is not None:
        a, b = a.round(digits), b.round(digits)
    a, b = a * scale, b * scale
    r = spark_ks(spark, a, b, coarse=bands, small=1)
    assert abs(r["ks_statistic"] - numpy_ks(a, b)) < 1e-12
    assert (r["baseline_samples"], r["current_samples"]) == (230, 140)


@pytest.mark.parametrize("shift", [0, 1, 9, 40, 64, 70])
def test_ks_of_a_shifted_grid_is_the_share_it_leaves(spark, shift):
    n = 64
    r = spark_ks(spark, range(n), range(shift, n + shift))
    assert r["ks_statistic"] == pytest.approx(min(shift, n) / n)


def test_ks_does_not_depend_on_sides_or_units(spark, rng):
    a, b = rng.exponential(2.0, 90), rng.uniform(0, 5, 50)
    d = spark_ks(spark, a, b)["ks_statistic"]
    assert spark_ks(spark, b, a)["ks_statistic"] == pytest.approx(d)
    assert spark_ks(spark, 3 * a - 7, 3 * b - 7)["ks_statistic"] == pytest.approx(d)
    assert spark_ks(spark, np.repeat(a, 3), np.repeat(b, 3))["ks_statistic"] == pytest.approx(d)


def test_ks_p_values(spark):
    """1 for equal samples, falling with the statistic and with the size of the samples."""
    p = [spark_ks(spark, range(50), range(s, 50 + s))["p_value"] for s in (0, 5, 10, 20, 50)]
    assert p[0] == 1.0 and p == sorted(p, reverse=True) and p[-1] < 1e-12
    larger = spark_ks(spark, np.repeat(range(50), 4), np.repeat(range(10, 60), 4))["p_value"]
    assert larger < p[2]
    nothing = spark_ks(spark, [1.5, 2.5], [])
    assert nothing["ks_statistic"] is None and nothing["p_value"] is None


def test_published_p_values_to_their_digits():
    """Logged for 580 against 160 samples."""
    for d, p in ((0.34677, "6.4e-14"), (0.21185, "2.1e-05"), (0.32565, "2.7e-12")):
        assert f"{ks.exact_p_value(d, 580, 160):.1e}" == p


def test_exact_p_value_equals_enumeration():
    """Every order of two samples, for all sizes up to 8 by 8."""
    for m, n in itertools.product(range(1, 9), repeat=2):
        gaps = Counter()
        for chosen in itertools.combinations(range(m + n), m):
            i = j = gap = 0
            picks = set(chosen)
            for k in range(m + n):
                i, j = (i + 1, j) if k in picks else (i, j + 1)
                gap = max(gap, abs(i * n - j * m))
            gaps[gap] += 1
        total = sum(gaps.values())
        for gap in gaps:
            share = sum(k for g, k in gaps.items() if g >= gap) / total
            assert ks.exact_p_value(gap / (m * n), m, n) == pytest.approx(share, rel=1e-12)


def test_exact_and_asymptotic_p_values_meet(spark):
    df = spark.createDataFrame([(0.02, 9000, 9000), (0.025, 10_000, 5000)], "d double, m long, n long")
    got = df.select(ks.ks_p_value("d", "m", "n").alias("p"), rules.kolmogorov_p_value(F.col("d"), F.col("m"), F.col("n")).alias("q"))
    assert all(r["p"] == pytest.approx(r["q"], rel=0.05) for r in got.collect())
    large = spark.createDataFrame([(0.02, 10_001, 5)], "d double, m long, n long")
    assert large.select(ks.ks_p_value("d", "m", "n").alias("p")).first()["p"] == pytest.approx(1.0)


def test_bands_are_even_beside_an_outlier(spark, rng):
    values = [*rng.normal(0, 1, 20_000).tolist(), 1e9, -1e12, float("inf")]
    counts = spark.createDataFrame([("m", v, 1, 0) for v in values], "g string, _v double, _b long, _c long")
    banded = ks._banded(counts, ["g"], 32, 1)
    sizes = sorted(r["count"] for r in banded.groupBy("_band").count().collect())
    assert len(sizes) > 900 and sizes[-1] < 5 * len(values) / 1024
    ends = banded.groupBy("_band").agg(F.min("_v").alias("low"), F.max("_v").alias("high")).orderBy("_band").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ends, ends[1:], strict=False))
    r = spark_ks(spark, values, rng.normal(0.5, 1, 9000), small=1)
    assert r["ks_statistic"] == pytest.approx(numpy_ks(values, rng.normal(0.5, 1, 9000)), abs=0.05)


def test_thresholds_by_metric(spark):
    names = [("temp_mean_3d", 0.35), ("precip_sum_3d", 0.5), ("wind_max_3d", 0.4), ("comfort", 0.4)]
    df = spark.createDataFrame(names, "m string, limit double")
    got = df.select("limit", rules.ks_threshold(F.col("m")).alias("t")).collect()
    assert [r["t"] for r in got] == [r["limit"] for r in got]


def feature_frame(spark, rows):
    return spark.createDataFrame(
        rows, "feature_date date, temp_mean_3d double, precip_sum_3d double, wind_max_3d double"
    )


def days(first, last):
    return [DAY - dt.timedelta(days=i) for i in range(first, last + 1)]


def test_windows_are_inclusive(spark):
    df = feature_frame(spark, [(d, 1.0, 1.0, 1.0) for d in days(0, 40)])
    r = drift.detect_feature_drift(df, DAY).where("metric_name = 'temp_mean_3d'").first()
    assert (r["baseline_n"], r["current_n"]) == (29, 8)
    assert r["mean_shift_std"] == 0 and not r["drift_detected"] and r["reasons"] == []


def test_replay_equals_single_checks(spark, rng):
    rows = [(d, *[float(x) for x in rng.integers(0, 40, 3)]) for d in days(0, 120) for _ in range(3)]
    df = feature_frame(spark, rows)
    replay = {
        (r["check_date"], r["metric_name"]): r for r in drift.replay_feature_drift(df).collect()
    }
    dates = sorted({k[0] for k in replay})
    for when in (dates[-1], dates[len(dates) // 2]):
        known = df.where(F.col("feature_date") <= F.lit(when))
        for r in drift.detect_feature_drift(known, when).collect():
            other = replay[(when, r["metric_name"])]
            for name in ("baseline_n", "current_n", "ks_statistic", "drift_detected"):
                assert r[name] == other[name]


def test_detection_reasons_and_severity(spark):
    rows = [(d, 10.0 + i % 3, 5.0, 20.0) for i, d in enumerate(days(8, 35))]
    rows += [(d, 30.0, 5.0, 20.0) for d in days(0, 6)]
    df = feature_frame(spark, rows)
    found = drift.detect_feature_drift(df, DAY)
    by = {r["metric_name"]: r for r in found.collect()}
    assert by["temp_mean_3d"]["drift_detected"] and len(by["temp_mean_3d"]["reasons"]) == 2
    assert not by["wind_max_3d"]["drift_detected"]
    log = {r["metric_name"]: r for r in drift.drift_log_rows(found, F.lit(DAY)).collect()}
    assert log["temp_mean_3d"]["drift_severity"] == "critical"
    assert log["wind_max_3d"]["drift_severity"] == "none"
    assert json.loads(log["temp_mean_3d"]["metadata"])["feature_type"] == "temp_mean_3d"


@pytest.mark.parametrize(
    "detected,score,expected",
    [(False, 9.0, "none"), (True, 0.3, "minor"), (True, 0.61, "major"), (True, 0.8, "critical")],
)
def test_severity(spark, detected, score, expected):
    df = spark.createDataFrame([(detected, score)], "d boolean, s double")
    assert df.select(rules.severity(F.col("d"), F.col("s"), F.lit(0.4))).first()[0] == expected


def test_missing_sides(spark):
    only_current = feature_frame(spark, [(DAY, 1.0, None, 1.0)])
    by = {r["metric_name"]: r for r in drift.detect_feature_drift(only_current, DAY).collect()}
    assert by["temp_mean_3d"]["reason"] == "no_baseline_data"
    assert by["precip_sum_3d"]["reason"] == "no_baseline_data"
    only_base = feature_frame(spark, [(DAY - dt.timedelta(days=20), 1.0, 1.0, 1.0)])
    by = {r["metric_name"]: r for r in drift.detect_feature_drift(only_base, DAY).collect()}
    assert by["temp_mean_3d"]["reason"] == "no_current_data"
    assert not any(r["drift_detected"] for r in by.values())


def score_frame(spark, rows):
    return spark.createDataFrame(rows, "feature_date date, profile_name string, comfort_score double")


def test_prediction_drift(spark):
    rows = [(d, "leisure", 20.0 + i) for i, d in enumerate(days(8, 35))]
    rows += [(d, "leisure", 90.0) for d in days(0, 6)]
    r = drift.detect_prediction_drift(score_frame(spark, rows), DAY).first()
    assert r["drift_detected"] and r["ks_statistic"] == 1.0
    none = drift.detect_prediction_drift(score_frame(spark, rows), DAY, "cyclist").first()
    assert none["reason"] == "no_baseline_predictions" and not none["drift_detected"]


def run_frame(spark, values, champion=None):
    rows = [
        ("regression", "test_r2", v, dt.date(2024, 1, 1) + dt.timedelta(days=i), i, i == champion)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "model_type string, metric_name string, metric_value double, created_at date,"
        "run_id long, is_champion boolean"
    )


@pytest.mark.parametrize(("last", "drifts"), [(0.75, True), (0.80, False), (0.95, False)])
def test_performance_drop_is_relative_to_the_mean(spark, last, drifts):
    """Seven runs at 0.875 and one after them, against the mean of all eight."""
    r = drift.model_drift(run_frame(spark, [0.875] * 7 + [last])).first()
    mean = (0.875 * 7 + last) / 8
    assert r["performance_drop"] == pytest.approx(1 - last / mean)
    assert r["drift_detected"] == drifts and (r["reason"] is not None) == drifts


def test_the_champion_counts_and_one_run_is_no_history(spark):
    values = [0.5, 0.625, 0.25]
    kept = drift.model_drift(run_frame(spark, values, champion=1)).first()
    assert kept["champion_value"] == 0.625 and not kept["drift_detected"]
    newest = drift.model_drift(run_frame(spark, values)).first()
    assert newest["champion_value"] == 0.25 and newest["drift_detected"]
    alone = drift.model_drift(run_frame(spark, values[:1])).first()
    assert alone["reason"] == "insufficient_history" and alone["performance_drop"] is None


def test_report(spark):
    rows = [(d, 10.0 + i % 3, 5.0, 20.0) for i, d in enumerate(days(8, 35))]
    rows += [(d, 30.0, 5.0, 20.0) for d in days(0, 6)]
    scores = score_frame(spark, [(d, "leisure", 50.0) for d in days(0, 35)])
    checks = drift.drift_checks(
        feature_frame(spark, rows), run_frame(spark, [0.99, 0.98]), scores, DAY
    )
    overall = drift.drift_overall(checks).first()
    assert overall["overall_drift_detected"] and overall["needs_retraining"]
    assert overall["recommendations"] == [
        "Feature drift detected in temp_mean_3d - consider retraining models"
    ]
    report = json.loads(drift.drift_report(checks, DAY).first()["report"])
    assert set(report) == {
        "timestamp", "feature_drift", "model_drift", "prediction_drift",
        "overall_drift_detected", "recommendations",
    }
    assert set(report["feature_drift"]) == {"temp_mean_3d", "precip_sum_3d", "wind_max_3d"}
    assert set(report["prediction_drift"]) == {"leisure"}


def test_prediction_drift_alone_does_not_retrain(spark):
    checks = spark.createDataFrame(
        [("feature_drift", "a", False, "x"), ("prediction_drift", "leisure", True, "y")],
        "section string, name string, drift_detected boolean, action string",
    )
    r = drift.drift_overall(checks).first()
    assert r["overall_drift_detected"] and not r["needs_retraining"] and r["n_drifted"] == 1


def lost_table():
    raise FileNotFoundError("no such table")


def report_of(spark, **sources):
    rows = [(d, 10.0 + i % 3, 5.0, 20.0) for i, d in enumerate(days(8, 35))]
    rows += [(d, 30.0, 5.0, 20.0) for d in days(0, 6)]
    known = {
        "features": lambda: feature_frame(spark, rows),
        "runs": lambda: run_frame(spark, [0.875] * 7 + [0.75]),
        "scores": lambda: score_frame(spark, [(d, "leisure", 20.0) for d in days(0, 35)]),
    }
    return drift.run_report(spark, **(known | sources), as_of=DAY, timestamp="2024-03-01T00:00:00")


def test_the_report_has_the_figures_of_each_check(spark):
    report = report_of(spark)
    temp = report["feature_drift"]["temp_mean_3d"]
    assert temp["drift_detected"] and temp["ks_statistic"] == 1.0 and 0 < temp["p_value"] < 1e-5
    assert temp["current_mean"] > temp["baseline_mean"] and len(temp["reasons"]) == 2
    assert report["model_drift"]["regression"]["drift_detected"]
    assert report["model_drift"]["kmeans"] == {"drift_detected": False, "reason": "insufficient_history"}
    assert not report["prediction_drift"]["leisure"]["drift_detected"]
    assert report["overall_drift_detected"] and len(report["recommendations"]) == 2


@pytest.mark.parametrize("lost", ["features", "runs", "scores"])
def test_a_lost_table_leaves_the_other_sections(spark, lost):
    report, whole = report_of(spark, **{lost: lost_table}), report_of(spark)
    section = {"features": "feature_drift", "runs": "model_drift", "scores": "prediction_drift"}[lost]
    for name in drift.ACTIONS:
        if name == section:
            assert all(e == {"error": "no such table"} for e in report[name].values())
        else:
            assert report[name] == whole[name]
    assert "overall_drift_detected" in report


def test_a_report_file_is_published_once_and_read_back(spark, tmp_path):
    report = report_of(spark, runs=lost_table)
    path = drift.write_report(spark, report, str(tmp_path), "20240301_000000")
    assert json.loads((tmp_path / "drift_report_20240301_000000.json").read_text()) == report
    assert path.endswith("drift_report_20240301_000000.json")
    with pytest.raises(FileExistsError):
        drift.write_report(spark, report, str(tmp_path), "20240301_000000")
    got = {(r["section"], r["name"]): r for r in drift.read_reports(spark, path).collect()}
    assert len(got) == 6 and got["model_drift", "kmeans"]["error"] == "no such table"
    assert got["feature_drift", "temp_mean_3d"]["p_value"] == report["feature_drift"]["temp_mean_3d"]["p_value"]
