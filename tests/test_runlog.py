"""The promotion rule against a plain loop."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayscout.operators import runlog

RUNS = "model_type string, metric_name string, metric_value double, created_at date, run_id long"


def frame(spark, values, kind="kmeans"):
    rows = [
        (kind, runlog.DECIDING_METRIC[kind], v, dt.date(2024, 1, 1) + dt.timedelta(days=i // 3), i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, RUNS)


def loop(values, delta):
    champion, out = None, []
    for i, v in enumerate(values):
        if champion is None or v > champion + delta:
            champion = v
            out.append(i)
    return out


def promoted(spark, values, kind="kmeans", **options):
    rows = runlog.promotions(frame(spark, values, kind), **options).orderBy("sequence").collect()
    return rows


def test_a_running_maximum_would_differ(spark):
    rows = promoted(spark, [0.50, 0.53, 0.56, 0.57, 0.70])
    assert [r["run_id"] for r in rows] == [0, 2, 4]
    assert [r["replaced_by"] for r in rows] == [2, 4, None]
    assert [r["is_champion"] for r in rows] == [False, False, True]


@pytest.mark.parametrize("kind", ["kmeans", "regression"])
@pytest.mark.parametrize("seed", range(4))
def test_equals_the_loop(spark, kind, seed):
    rng = random.Random(seed)
    digits = 3 if seed % 2 else 6
    values = [round(rng.random() ** (1 + seed), digits) for _ in range(400)]
    options = {"blocks": 1 + 4 * seed, "listed": (0, 3, 256, 1)[seed]}
    rows = promoted(spark, values, kind, **options)
    want = loop(values, runlog.PROMOTION_DELTA[kind])
    assert [r["run_id"] for r in rows] == want and [r["sequence"] for r in rows] == list(range(1, len(want) + 1))
    assert [r["replaced_by"] for r in rows] == [*want[1:], None]
    assert [r["is_champion"] for r in rows] == [False] * (len(want) - 1) + [True]


@pytest.mark.parametrize("listed", [0, 256])
def test_two_slowly_rising_logs_over_many_blocks(spark, listed):
    """Runs rise by far less than the gain, with drops between, in two logs of one frame."""
    rng = random.Random(8)
    logs = {k: [i / 900 + rng.choice([0, 0, -0.3]) for i in range(900)] for k in runlog.PROMOTION_DELTA}
    both = frame(spark, logs["kmeans"]).unionByName(frame(spark, logs["regression"], "regression"))
    got = {}
    for r in runlog.promotions(both, blocks=9, listed=listed).orderBy("sequence").collect():
        got.setdefault(r["model_type"], []).append(r["run_id"])
    assert got == {k: loop(v, runlog.PROMOTION_DELTA[k]) for k, v in logs.items()}


def test_a_block_is_a_function_of_its_entry():
    """Outcomes listed for a block, against the loop from every entry they cover."""
    rng = random.Random(2)
    for _ in range(50):
        floor, gain = 1.0, 0.05
        values = sorted({floor + rng.random() * 0.3 for _ in range(30)})
        block = pd.DataFrame({"model_type": "kmeans", "created_at": range(len(values)), "run_id": range(len(values)), "metric_value": values, "block": 4})
        r = runlog._outcomes({("kmeans", 4): floor}, 256)(block).iloc[0]
        for _ in range(40):
            entry = floor - gain * rng.random()
            won = []
            champion = entry
            for i, v in enumerate(values):
                if v > champion + gain:
                    champion = v
                    won.append(i)
            if won:
                at = next(k for k, s in enumerate(r["start"]) if s > entry + gain)
                assert (r["end"][at], r["wins"][at], r["winner"][at]) == (champion, len(won), won[0])


def test_no_task_reads_more_than_a_block(spark):
    """Two million runs, each of which wins."""
    n, blocks = 2_000_000, 40
    runs = spark.range(n).selectExpr(
        "'kmeans' AS model_type", "'silhouette_score' AS metric_name", "CAST(id AS DOUBLE) AS metric_value",
        "DATE '2024-01-01' AS created_at", "id AS run_id",
    )
    found = runlog.promotions(runs, blocks=blocks)
    r = found.agg(F.count("*").alias("n"), F.max("sequence").alias("last"), F.count_if(F.expr("replaced_by = run_id + 1")).alias("linked")).first()
    assert (r["n"], r["last"], r["linked"]) == (n, n, n - 1)
    read = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0])
    assert read.groupBy("block").count().agg(F.max("count")).first()[0] < 2 * n / blocks


@pytest.mark.parametrize("kind", ["kmeans"])
def test_no_runs(spark, kind):
    assert runlog.promotions(frame(spark, [], kind)).count() == 0
    assert [r["run_id"] for r in promoted(spark, [float("nan"), None, 0.4], kind)] == [2]


def test_only_the_last_promoted_run_is_champion(spark):
    values = [0.1, 0.4, 0.2, 0.9, 0.3]
    flagged = runlog.flag_champions(frame(spark, values))
    assert flagged.count() == 5
    assert [r["run_id"] for r in flagged.where("is_champion").collect()] == [3]
    assert runlog.current_champion(flagged).first()["metric_value"] == 0.9


def test_last_runs_and_single_rule(spark):
    got = runlog.last_runs(frame(spark, [i / 100 for i in range(30)])).collect()
    assert sorted(r["run_id"] for r in got) == list(range(20, 30))
    assert runlog.beats_champion("kmeans", 0.1, None)
    assert not runlog.beats_champion("kmeans", 0.54, 0.5)
    assert runlog.beats_champion("regression", 0.52, 0.5)


def test_the_stored_metric_decides(spark):
    """A gain of more than the delta that rounding to three decimals would hide."""
    values = [0.9004, 0.91045, 0.920449, 0.92046]
    assert [r["run_id"] for r in promoted(spark, values, "regression")] == loop(values, 0.01) == [0, 1, 3]


def test_a_log_that_always_rises(spark):
    """Every run is higher than all before it; nothing is gathered into one array."""
    n = 200_000
    runs = spark.range(n).selectExpr(
        "'kmeans' AS model_type", "'silhouette_score' AS metric_name", f"id / {n} AS metric_value",
        "DATE '2024-01-01' AS created_at", "id AS run_id",
    )
    got = [r["run_id"] for r in runlog.promotions(runs).orderBy("sequence").collect()]
    assert got == loop([i / n for i in range(n)], runlog.PROMOTION_DELTA["kmeans"])
