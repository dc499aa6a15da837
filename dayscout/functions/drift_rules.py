"""Thresholds, severities and window bounds of the drift checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Drift thresholds and window lengths.
DRIFT_THRESHOLDS = {
    "ks_statistic": 0.4,
    "performance_drop": 0.10,
    "feature_shift": 2.5,
    "temp_ks_threshold": 0.35,
    "precip_ks_threshold": 0.5,
    "wind_ks_threshold": 0.4,
}
BASELINE_WINDOW_DAYS = 28
CURRENT_WINDOW_DAYS = 7


def ks_threshold(metric: Column) -> Column:
    """KS threshold by metric name."""
    t = DRIFT_THRESHOLDS
    return (
        F.when(metric.contains("temp"), t["temp_ks_threshold"])
        .when(metric.contains("precip"), t["precip_ks_threshold"])
        .when(metric.contains("wind"), t["wind_ks_threshold"])
        .otherwise(t["ks_statistic"])
    )


def severity(detected: Column, score: Column, threshold: Column) -> Column:
    return (
        F.when(~detected, "none")
        .when(score < threshold * 1.5, "minor")
        .when(score < threshold * 2.0, "major")
        .otherwise("critical")
    )


def mean_shift(current_mean: Column, baseline_mean: Column, baseline_std: Column) -> Column:
    """Shift of the mean in baseline (population) standard deviations; 0 if constant."""
    return F.when(
        baseline_std > 0, F.abs(current_mean - baseline_mean) / baseline_std
    ).otherwise(0.0)


def feature_drift_detected(ks: Column, threshold: Column, shift: Column) -> Column:
    return (ks > threshold) | (shift > DRIFT_THRESHOLDS["feature_shift"])


def feature_drift_reasons(ks: Column, threshold: Column, shift: Column) -> Column:
    """Array with one sentence per rule that fired."""
    limit = DRIFT_THRESHOLDS["feature_shift"]
    return F.array_compact(
        F.array(
            F.when(
                ks > threshold,
                F.format_string("KS statistic %.3f > threshold %s", ks, threshold.cast("string")),
            ),
            F.when(
                shift > limit,
                F.format_string(f"Mean shifted %.2f std devs (threshold: {limit})", shift),
            ),
        )
    )


def performance_drop(history_mean: Column, champion: Column) -> Column:
    return (history_mean - champion) / history_mean


def performance_degraded(drop: Column) -> Column:
    return drop > DRIFT_THRESHOLDS["performance_drop"]


def kolmogorov_p_value(ks: Column, n1: Column, n2: Column, terms: int = 24) -> Column:
    """Asymptotic two-sample p-value with the usual small-sample correction.

    For the logged metadata only; no decision depends on it.
    """
    en = F.nullif(F.sqrt(n1 * n2 / F.nullif(n1 + n2, F.lit(0))), F.lit(0.0))
    lam = (en + 0.12 + 0.11 / en) * ks
    def term(total: Column, k: Column) -> Column:
        return total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), term)
    # Below 0.3 the tail is 1 to five digits and the alternating series converges badly.
    tail = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series))
    return F.when(lam < 0.3, 1.0).when(lam.isNotNull(), tail)


def baseline_bounds(as_of: Column) -> tuple[Column, Column]:
    """First and last day of the baseline, both inclusive (29 days)."""
    return (
        F.date_sub(as_of, BASELINE_WINDOW_DAYS + CURRENT_WINDOW_DAYS),
        F.date_sub(as_of, CURRENT_WINDOW_DAYS),
    )


def current_start(as_of: Column) -> Column:
    """First day of the current window; it is also the baseline's last day."""
    return F.date_sub(as_of, CURRENT_WINDOW_DAYS)
