"""Two-sample Kolmogorov-Smirnov statistic as grouped prefix sums, and its p-value.

Spark ships only a one-sample test. Equal values are counted first, so the exchange
carries one row per distinct value. The running sums are two-level: inside bands of
neighbouring values, and over the band totals. The bands' limits are quantiles of a
mergeable sketch (KLL) of each group's distinct values, so they are about equally deep
whatever outliers there are; the sums over them are exact. No task sees a whole sample,
even when the values are not rounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayscout.functions.drift_rules import kolmogorov_p_value


def two_sample_summary(
    samples: DataFrame, group: Sequence[str], value: str, current: str
) -> DataFrame:
    """Count, mean, population deviation, extremes of both samples, side by side.

    ``current`` names a boolean column: true for the current sample, false for the
    baseline.
    """
    out = []
    for side, flag in (("baseline", ~F.col(current)), ("current", F.col(current))):
        v = F.when(flag, F.col(value))
        out += [
            F.count(v).alias(f"{side}_n"),
            F.avg(v).alias(f"{side}_mean"),
            F.stddev_pop(v).alias(f"{side}_std"),
            F.min(v).alias(f"{side}_min"),
            F.max(v).alias(f"{side}_max"),
        ]
    return samples.groupBy(*group).agg(*out)


def _ahead(column: str, over) -> Column:
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


#: bands per group are COARSE ** 2; groups of fewer distinct values than SMALL are one band
COARSE, SMALL, SKETCH = 32, 4_096, 4_096


def _banded(counts: DataFrame, group: Sequence[str], coarse: int, small: int) -> DataFrame:
    """Adds ``_band``: how many limits of the group are at most ``_v``. The limits are looked
    up in two steps, among every ``coarse``-th and then among those up to the next."""
    ranks = F.lit([k / coarse**2 for k in range(1, coarse**2)])
    value = F.col("_v").cast("double")
    large = counts.groupBy(*group).agg(F.count("*").alias("_k")).where(F.col("_k") >= small)
    limits = (
        counts.join(large.select(*group), list(group), "left_semi")
        .groupBy(*group)
        .agg(F.kll_sketch_agg_double(value, SKETCH).alias("_sketch"))
        .select(*group, F.kll_sketch_get_quantile_double("_sketch", ranks).alias("_limits"))
        .withColumn("_outer", F.expr(f"filter(_limits, (x, i) -> (i + 1) % {coarse} = 0)"))
    )
    step = F.size(F.filter("_outer", lambda x: x <= value))
    part = F.slice("_limits", F.col("_step") * coarse + 1, F.lit(coarse - 1))
    fine = F.size(F.filter(part, lambda x: x <= value))
    band = F.when(F.col("_limits").isNull(), 0).otherwise(F.col("_step") * coarse + fine)
    return (
        counts.join(limits, list(group), "left")
        .withColumn("_step", step)
        .withColumn("_band", band)
        .drop("_limits", "_outer", "_step")
    )


def ks_two_sample(
    samples: DataFrame,
    group: Sequence[str],
    value: str,
    current: str,
    coarse: int = COARSE,
    small: int = SMALL,
) -> DataFrame:
    """Per group: the counts, the KS statistic and its p-value.

    A group with an empty side has a NULL statistic and p-value."""
    v = F.col(value)
    counts = (
        samples.where(v.isNotNull())
        .groupBy(*group, v.alias("_v"))
        .agg(
            F.count_if(~F.col(current)).alias("_b"),
            F.count_if(F.col(current)).alias("_c"),
        )
    )
    counts = _banded(counts, group, coarse, small)
    inside = Window.partitionBy(*group, "_band").orderBy("_v")
    running = counts.select(
        *group,
        "_band",
        "_b",
        "_c",
        F.sum("_b").over(inside).alias("_rb"),
        F.sum("_c").over(inside).alias("_rc"),
    )
    totals = running.groupBy(*group, "_band").agg(F.sum("_b").alias("_b"), F.sum("_c").alias("_c"))
    over_bands = Window.partitionBy(*group).orderBy("_band")
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        *group,
        "_band",
        _ahead("_b", over_bands).alias("_ab"),
        _ahead("_c", over_bands).alias("_ac"),
        F.sum("_b").over(whole).alias("_nb"),
        F.sum("_c").over(whole).alias("_nc"),
    )
    n_b, n_c = F.nullif(F.col("_nb"), F.lit(0)), F.nullif(F.col("_nc"), F.lit(0))
    gap = F.abs((F.col("_ab") + F.col("_rb")) / n_b - (F.col("_ac") + F.col("_rc")) / n_c)
    found = (
        running.select(*group, "_band", "_rb", "_rc")
        .join(offsets, [*group, "_band"])
        .groupBy(*group)
        .agg(
            F.max(gap).alias("ks_statistic"),
            F.max("_nb").alias("baseline_samples"),
            F.max("_nc").alias("current_samples"),
        )
    )
    return found.withColumn(
        "p_value", ks_p_value("ks_statistic", "baseline_samples", "current_samples")
    )


#: samples up to this size have an exact p-value, as in the usual statistics libraries
EXACT_UP_TO = 10_000


def _outside(gaps: np.ndarray, m: int, n: int) -> np.ndarray:
    """For each gap, the share of the lattice paths from (0, 0) to (m, n) that meet a point
    (i, j) with |i * n - j * m| >= gap, all gaps in one pass. By anti-diagonals: a path to
    (i, j) came from (i - 1, j) with chance i / (i + j). All terms are positive, so small
    shares lose no digits."""
    m, n = min(m, n), max(m, n)
    limit = gaps[:, None]
    share = np.zeros((len(gaps), m + 2))  # column i + 1 is (i, s - i) on the diagonal s
    for s in range(1, m + n + 1):
        low, high = max(0, s - n), min(m, s)
        i = np.arange(low, high + 1)
        now = (share[:, low : high + 1] * i + share[:, low + 1 : high + 2] * (s - i)) / s
        np.putmask(now, np.abs(i * (m + n) - s * m) >= limit, 1.0)
        share[:, low + 1 : high + 2] = now
    return np.where(gaps <= 0, 1.0, share[:, m + 1])


def exact_p_values(statistics: np.ndarray, m: int, n: int, at_once: int = 256) -> np.ndarray:
    """P(D >= statistic), for samples of m and n values from one continuous distribution:
    one recurrence for up to ``at_once`` statistics of a pair of sizes."""
    step = math.gcd(m, n)  # D times m * n is a multiple of it
    gaps, where = np.unique(step * np.rint(statistics * m * n / step).astype(np.int64), return_inverse=True)
    parts = [_outside(gaps[k : k + at_once], m, n) for k in range(0, len(gaps), at_once)]
    return np.concatenate(parts)[where]


def exact_p_value(statistic: float, m: int, n: int) -> float:
    return float(exact_p_values(np.array([statistic]), m, n)[0])


def _exact(statistic: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    out = pd.Series(np.nan, statistic.index, "float64")
    known = statistic.notna()
    for (a, b), d in statistic[known].groupby([m[known], n[known]]):
        out[d.index] = exact_p_values(d.to_numpy(float), int(a), int(b))
    return out.astype(object).where(known, None)


def ks_p_value(statistic: str, m: str, n: str) -> Column:
    """Exact for samples of up to ``EXACT_UP_TO`` values, else asymptotic. One row per group
    comes here, never a sample."""
    d, a, b = F.col(statistic), F.col(m), F.col(n)
    few = F.greatest(a, b) <= EXACT_UP_TO
    exact = F.pandas_udf(_exact, "double")(F.when(few, d), F.when(few, a).otherwise(1), F.when(few, b).otherwise(1))
    return F.when(d.isNull(), F.lit(None)).when(few, exact).otherwise(kolmogorov_p_value(d, a, b))
