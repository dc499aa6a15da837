"""Drift monitoring: features, predictions and model runs, and the combined report."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayscout.functions import drift_rules as rules
from dayscout.operators.ks import ks_two_sample, two_sample_summary
from dayscout.operators.learning import at_once
from dayscout.operators.runlog import model_drift
from dayscout.operators.writes import conform
from dayscout.schemas import DRIFT_LOG, REGRESSION_FEATURES
from dayscout.sources.dims import DEFAULT_PROFILE
from dayscout.sources.files import Files
from dayscout.sources.scans import When, day


def _sides(on: Column, as_of: Column) -> Column:
    """The samples a day belongs to: false = baseline, true = current. Both windows
    are inclusive, so the day between them is in both."""
    first, last = rules.baseline_bounds(as_of)
    return F.array_compact(
        F.array(
            F.when(on.between(first, last), F.lit(False)),
            F.when(on >= rules.current_start(as_of), F.lit(True)),
        )
    )


def _unpivot(metrics: Sequence[str]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(m).alias("metric_name"), F.col(m).alias("value"))
                for m in metrics
            ]
        )
    )


def feature_samples(
    features: DataFrame, as_of: When, metrics: Sequence[str] = tuple(REGRESSION_FEATURES)
) -> DataFrame:
    """(metric_name, value, is_current) for one check date; NULL values are left out."""
    on, when = F.col("feature_date"), day(as_of)
    return (
        features.where(on >= rules.baseline_bounds(when)[0])
        .select(*metrics, F.explode(_sides(on, when)).alias("is_current"))
        .select("is_current", _unpivot(metrics))
        .where(F.col("value").isNotNull())
    )


def replayed_samples(
    features: DataFrame,
    metrics: Sequence[str] = tuple(REGRESSION_FEATURES),
    every_days: int = 7,
    by: Sequence[str] = (),
) -> DataFrame:
    """The samples of every past check, for check dates ``every_days`` apart, next to
    the columns in ``by`` (such as the place).

    A day lies in the windows of at most ceil(36 / every_days) checks, so the whole
    history is one bounded fan-out instead of a loop over dates.
    """
    span = rules.BASELINE_WINDOW_DAYS + rules.CURRENT_WINDOW_DAYS
    on = F.col("feature_date")
    number = F.unix_date(on)
    first = (F.ceil(number / every_days) * every_days).cast("int")
    last_day = features.agg(F.max("feature_date")).scalar()
    last = F.least(number + span, F.unix_date(last_day))
    checks = F.when(first <= last, F.sequence(first, last, F.lit(every_days)))
    return (
        features.select(*by, *metrics, on, F.explode(checks).alias("_check"))
        .withColumn("check_date", F.date_from_unix_date("_check"))
        .select(
            *by,
            *metrics,
            "check_date",
            F.explode(_sides(on, F.col("check_date"))).alias("is_current"),
        )
        .select(*by, "check_date", "is_current", _unpivot(metrics))
        .where(F.col("value").isNotNull())
    )


def _missing_reason(kind: str) -> Column:
    return F.when(F.col("baseline_n") == 0, f"no_baseline_{kind}").when(
        F.col("current_n") == 0, f"no_current_{kind}"
    )


def compare_samples(samples: DataFrame, group: Sequence[str]) -> DataFrame:
    """Summary, KS and mean shift per group; one row even if a side is empty."""
    summary = two_sample_summary(samples, group, "value", "is_current")
    ks = ks_two_sample(samples, group, "value", "is_current").select(
        *group, "ks_statistic", "p_value"
    )
    shift = rules.mean_shift(F.col("current_mean"), F.col("baseline_mean"), F.col("baseline_std"))
    return summary.join(ks, list(group), "left").withColumn("mean_shift_std", shift)


def feature_drift(samples: DataFrame, group: Sequence[str] = ("metric_name",)) -> DataFrame:
    """Feature drift per group: KS above the metric's threshold, or a mean shift."""
    checked = (
        compare_samples(samples, group)
        .withColumn("threshold", rules.ks_threshold(F.col("metric_name")))
        .withColumn("reason", _missing_reason("data"))
    )
    ks, threshold, shift = F.col("ks_statistic"), F.col("threshold"), F.col("mean_shift_std")
    usable = F.col("reason").isNull()
    return checked.withColumn(
        "drift_detected",
        usable & F.coalesce(rules.feature_drift_detected(ks, threshold, shift), F.lit(False)),
    ).withColumn(
        "reasons", F.when(usable, rules.feature_drift_reasons(ks, threshold, shift))
    )


def detect_feature_drift(
    features: DataFrame, as_of: When, metrics: Sequence[str] = tuple(REGRESSION_FEATURES)
) -> DataFrame:
    """One row per metric on one check date, also for a metric without any data."""
    found = feature_drift(feature_samples(features, as_of, metrics))
    spark = features.sparkSession
    wanted = spark.createDataFrame([(m,) for m in metrics], "metric_name string")
    zero = {"baseline_n": 0, "current_n": 0, "drift_detected": False, "reason": "no_baseline_data"}
    absent = F.col("baseline_n").isNull()
    joined = wanted.join(found, "metric_name", "left").withColumn("_absent", absent)
    for name, value in zero.items():
        joined = joined.withColumn(name, F.when(F.col("_absent"), F.lit(value)).otherwise(F.col(name)))
    return joined.drop("_absent")


def replay_feature_drift(
    features: DataFrame, every_days: int = 7, by: Sequence[str] = ()
) -> DataFrame:
    """Feature drift of every past check; with ``by``, of each place on its own."""
    samples = replayed_samples(features, every_days=every_days, by=by)
    return feature_drift(samples, [*by, "check_date", "metric_name"])


def prediction_samples(scores: DataFrame, as_of: When, profile: str) -> DataFrame:
    on, when = F.col("feature_date"), day(as_of)
    return scores.where(
        (F.col("profile_name") == profile) & (on >= rules.baseline_bounds(when)[0])
    ).select(
        F.col("profile_name"),
        F.col("comfort_score").alias("value"),
        F.explode(_sides(on, when)).alias("is_current"),
    )


def detect_prediction_drift(
    scores: DataFrame, as_of: When, profile: str = DEFAULT_PROFILE
) -> DataFrame:
    """KS of one profile's scores against the general threshold. One row, always."""
    compared = compare_samples(prediction_samples(scores, as_of, profile), ["profile_name"])
    limit = rules.DRIFT_THRESHOLDS["ks_statistic"]
    spark = scores.sparkSession
    wanted = spark.createDataFrame([(profile,)], "profile_name string")
    full = wanted.join(compared, "profile_name", "left").fillna(0, ["baseline_n", "current_n"])
    return full.withColumn("threshold", F.lit(limit)).withColumn(
        "reason", _missing_reason("predictions")
    ).withColumn(
        "drift_detected", F.coalesce(F.col("ks_statistic") > limit, F.lit(False))
    )


def drift_log_rows(drift: DataFrame, check_timestamp: Column) -> DataFrame:
    """Feature checks as rows of the drift log, with severity and JSON metadata."""
    metadata = F.to_json(
        F.struct(
            "p_value",
            "mean_shift_std",
            F.col("baseline_n").alias("baseline_samples"),
            F.col("current_n").alias("current_samples"),
            F.col("threshold").alias("threshold_used"),
            F.col("metric_name").alias("feature_type"),
        )
    )
    logged = drift.where(F.col("reason").isNull())
    rows = logged.select(
        check_timestamp.cast("timestamp").alias("check_timestamp"),
        F.lit("feature").alias("check_type"),
        "metric_name",
        F.col("current_mean").alias("metric_value"),
        F.col("baseline_mean").alias("baseline_value"),
        F.col("ks_statistic").alias("drift_score"),
        "drift_detected",
        F.col("threshold").alias("threshold_used"),
        rules.severity(
            F.col("drift_detected"), F.col("ks_statistic"), F.col("threshold")
        ).alias("drift_severity"),
        metadata.alias("metadata"),
    )
    return conform(rows, DRIFT_LOG)


def drift_checks(
    features: DataFrame,
    runs: DataFrame,
    scores: DataFrame,
    as_of: When,
    profile: str = DEFAULT_PROFILE,
) -> DataFrame:
    """All checks in one long frame: section, name, score, flag, reason, action."""
    fields = ["section", "name", "score", "drift_detected", "reason", "action"]
    by_feature = detect_feature_drift(features, as_of).select(
        F.lit("feature_drift").alias("section"),
        F.col("metric_name").alias("name"),
        F.col("ks_statistic").alias("score"),
        "drift_detected",
        F.coalesce("reason", F.nullif(F.array_join("reasons", "; "), F.lit(""))).alias("reason"),
        F.format_string(
            "Feature drift detected in %s - consider retraining models", "metric_name"
        ).alias("action"),
    )
    watched = (
        ((F.col("model_type") == "regression") & (F.col("metric_name") == "test_r2"))
        | ((F.col("model_type") == "kmeans") & (F.col("metric_name") == "silhouette_score"))
    )
    by_model = model_drift(runs.where(watched)).select(
        F.lit("model_drift").alias("section"),
        F.col("model_type").alias("name"),
        F.col("performance_drop").alias("score"),
        "drift_detected",
        "reason",
        F.format_string(
            "%s model performance degraded - trigger retraining", F.initcap("model_type")
        ).alias("action"),
    )
    by_prediction = detect_prediction_drift(scores, as_of, profile).select(
        F.lit("prediction_drift").alias("section"),
        F.col("profile_name").alias("name"),
        F.col("ks_statistic").alias("score"),
        "drift_detected",
        "reason",
        F.lit("Prediction distributions shifted - investigate seasonal effects").alias("action"),
    )
    union = by_feature.unionByName(by_model).unionByName(by_prediction)
    return union.select(*fields)


#: fixed values: the sections of the report, their names, and what is advised on a drift
MODEL_METRICS = {"regression": "test_r2", "kmeans": "silhouette_score"}
ACTIONS = {
    "feature_drift": "Feature drift detected in {name} - consider retraining models",
    "model_drift": "{title} model performance degraded - trigger retraining",
    "prediction_drift": "Prediction distributions shifted - investigate seasonal effects",
}
_FEATURE_FIELDS = [
    "drift_detected", "ks_statistic", "p_value", "mean_shift_std", "baseline_mean", "current_mean", "reasons", "reason",
]
_MODEL_FIELDS = ["drift_detected", "champion_value", "historical_mean", "performance_drop", "reason"]
_PREDICTION_FIELDS = ["drift_detected", "ks_statistic", "p_value", "baseline_mean", "current_mean", "reason"]

Source = Callable[[], DataFrame]


def run_report(
    spark: SparkSession,
    features: Source,
    runs: Source,
    scores: Source,
    as_of: When,
    timestamp: str,
    profile: str = DEFAULT_PROFILE,
    metrics: Sequence[str] = tuple(REGRESSION_FEATURES),
) -> dict:
    """The report as one nested dict. Every check runs on its own, at once with the others;
    what it raises, a table that cannot be read included, is the ``error`` of its entry and
    leaves the others as they are. The sources are called inside the checks."""
    def of_model(kind: str, metric: str) -> DataFrame:
        watched = (F.col("model_type") == kind) & (F.col("metric_name") == metric)
        return model_drift(runs().where(watched))

    checks: list[tuple[str, str, list[str], Source]] = [
        ("feature_drift", m, _FEATURE_FIELDS, lambda m=m: detect_feature_drift(features(), as_of, [m]))
        for m in metrics
    ]
    checks += [
        ("model_drift", kind, _MODEL_FIELDS, lambda k=kind, m=metric: of_model(k, m))
        for kind, metric in MODEL_METRICS.items()
    ]
    checks.append(
        ("prediction_drift", profile, _PREDICTION_FIELDS, lambda: detect_prediction_drift(scores(), as_of, profile))
    )

    def entry(check: tuple[str, str, list[str], Source]) -> dict:
        _, _, fields, rows = check
        try:
            found = rows().select(*fields).first()
            if found is None:
                return {"drift_detected": False, "reason": "insufficient_history"}
            return {k: v for k, v in found.asDict().items() if v is not None and v == v}
        except Exception as e:  # one check must not take the report with it
            return {"error": str(e).strip().split("\n")[0] or type(e).__name__}

    report: dict = {"timestamp": timestamp, "feature_drift": {}, "model_drift": {}, "prediction_drift": {}}
    advice = []
    for (section, name, _, _), found in zip(checks, at_once(spark, entry, checks), strict=True):
        report[section][name] = found
        if found.get("drift_detected"):
            advice.append(ACTIONS[section].format(name=name, title=name.capitalize()))
    return report | {"overall_drift_detected": bool(advice), "recommendations": advice}


def write_report(spark: SparkSession, report: dict, folder: str, name: str) -> str:
    """Publish the report as ``drift_report_<name>.json``: written aside and renamed, so that
    a reader finds all of it or none. A report of that name is never replaced."""
    path = f"{folder.rstrip('/')}/drift_report_{name}.json"
    if not Files(spark).publish(path, json.dumps(report, indent=2, allow_nan=False)):
        raise FileExistsError(path)
    return path


_ENTRY = (
    "drift_detected boolean, ks_statistic double, p_value double, mean_shift_std double, baseline_mean double,"
    " current_mean double, champion_value double, historical_mean double, performance_drop double,"
    " reasons array<string>, reason string, error string"
)
REPORT_SCHEMA = (
    "timestamp string, overall_drift_detected boolean, recommendations array<string>, "
    + ", ".join(f"{section} map<string, struct<{_ENTRY.replace(' ', ':').replace(',:', ', ')}>>" for section in ACTIONS)
)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per check of all report files below a path: timestamp, section, name, and the
    figures of the check."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", REPORT_SCHEMA).alias("r"))
    parts = None
    for section in ACTIONS:
        part = whole.select(
            "r.timestamp", F.lit(section).alias("section"), F.explode(F.col(f"r.{section}")).alias("name", "e")
        ).select("timestamp", "section", "name", "e.*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def drift_overall(checks: DataFrame) -> DataFrame:
    """Any drift at all, whether to retrain (predictions alone do not), and the actions.

    One row per check comes in (six), so collecting the actions is bounded.
    """
    retrains = F.col("section").isin("feature_drift", "model_drift")
    fired = F.when(F.col("drift_detected"), F.struct("section", "name", "action"))
    return checks.agg(
        F.bool_or("drift_detected").alias("overall_drift_detected"),
        F.bool_or(F.col("drift_detected") & retrains).alias("needs_retraining"),
        F.count_if("drift_detected").alias("n_drifted"),
        F.transform(F.array_sort(F.collect_list(fired)), lambda x: x["action"]).alias(
            "recommendations"
        ),
    )


def drift_report(checks: DataFrame, timestamp: When) -> DataFrame:
    """The nested report as one JSON text."""
    def section(name: str) -> Column:
        detail = F.struct("drift_detected", "score", "reason")
        entry = F.when(F.col("section") == name, F.struct("name", detail.alias("detail")))
        return F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name)

    fired = F.when(F.col("drift_detected"), F.struct("section", "name", "action"))
    nested = checks.agg(
        section("feature_drift"),
        section("model_drift"),
        section("prediction_drift"),
        F.bool_or("drift_detected").alias("overall_drift_detected"),
        F.transform(F.array_sort(F.collect_list(fired)), lambda x: x["action"]).alias(
            "recommendations"
        ),
    )
    return nested.select(
        F.to_json(
            F.struct(day(timestamp).cast("string").alias("timestamp"), *nested.columns)
        ).alias("report")
    )
