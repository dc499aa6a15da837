"""The log of model runs: newest runs, champions, and the promotion rule.

Rows are ordered by (created_at, run_id); ``run_id`` makes the order total.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayscout.functions.drift_rules import performance_degraded, performance_drop
from dayscout.operators.ranking import top_k
from dayscout.sources.files import scratch_dir

# The metric that decides per model type, and the gain needed to replace a
# champion.
DECIDING_METRIC = {"kmeans": "silhouette_score", "regression": "test_r2"}
PROMOTION_DELTA = {"kmeans": 0.05, "regression": 0.01}
DEFAULT_DELTA = 0.01
HISTORY_RUNS = 10

_ORDER = ["created_at", "run_id"]


def order_key() -> Column:
    return F.struct(*_ORDER)


def last_runs(runs: DataFrame, n: int = HISTORY_RUNS) -> DataFrame:
    """Newest n runs per (model type, metric)."""
    newest_first = [F.col(c).desc() for c in _ORDER]
    return top_k(runs, ["model_type", "metric_name"], newest_first, n)


def current_champion(runs: DataFrame) -> DataFrame:
    """Newest champion row per model type."""
    row = F.struct("metric_name", "metric_value", *_ORDER)
    return (
        runs.where("is_champion")
        .groupBy("model_type")
        .agg(F.max_by(row, order_key()).alias("c"))
        .select("model_type", "c.*")
    )


def history_stats(runs: DataFrame, n: int = HISTORY_RUNS) -> DataFrame:
    """Mean and sample deviation of the newest n runs, with the champion among them
    (or, without one, the newest run)."""
    newest = F.max_by("metric_value", order_key())
    champion = F.max_by("metric_value", F.when(F.col("is_champion"), order_key()))
    has_champion = F.bool_or("is_champion")
    return last_runs(runs, n).groupBy("model_type", "metric_name").agg(
        F.count("*").alias("n_runs"),
        F.avg("metric_value").alias("historical_mean"),
        F.stddev_samp("metric_value").alias("historical_std"),
        F.when(has_champion, champion).otherwise(newest).alias("champion_value"),
    )


def model_drift(runs: DataFrame, n: int = HISTORY_RUNS) -> DataFrame:
    """Champion against the mean of the newest runs; fewer than two runs never drift."""
    drop = performance_drop(F.col("historical_mean"), F.col("champion_value"))
    enough = F.col("n_runs") >= 2
    degraded = enough & F.coalesce(performance_degraded(drop), F.lit(False))
    text = F.format_string("Performance dropped %.2f%% (threshold: 10.00%%)", drop * 100)
    return history_stats(runs, n).select(
        "model_type",
        "metric_name",
        "n_runs",
        "champion_value",
        "historical_mean",
        "historical_std",
        F.when(enough, drop).alias("performance_drop"),
        degraded.alias("drift_detected"),
        F.when(~enough, "insufficient_history").when(degraded, text).alias("reason"),
    )


_PROMOTED = [
    "model_type", "sequence", "created_at", "run_id", "metric_value", "replaced_by", "is_champion",
]

#: champions at the entry of a block for which its outcome is listed; more are looked up
LISTED = 256


def _gain(model_type: str) -> float:
    return PROMOTION_DELTA.get(model_type, DEFAULT_DELTA)


def _maxima(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of sorted runs, those higher than all before them in the task: only they can win.
    A task is a block."""
    from pyspark import TaskContext

    block, kind, highest = TaskContext.get().partitionId(), None, -np.inf
    for b in batches:
        keep = np.zeros(len(b), bool)
        for i, (k, v) in enumerate(zip(b["model_type"], b["metric_value"].tolist(), strict=True)):
            if k != kind:
                kind, highest = k, -np.inf
            if v > highest or highest == -np.inf:
                keep[i], highest = True, v
        yield b[keep].assign(block=block)


def _chains(values: np.ndarray, gain: float) -> tuple[list[int], list[int], list[int]]:
    """(next, last, count) for each value of a rising block: the place of the first later
    value that beats it by more than the gain (the length if none does), the place of the
    champion at the end once this one has won, and how many win until then."""
    following = np.searchsorted(values, values + gain, "right").tolist()
    n = len(following)
    last, count = list(range(n)), [1] * n
    for i in range(n - 1, -1, -1):
        if following[i] < n:
            last[i], count[i] = last[following[i]], count[following[i]] + 1
    return following, last, count


def _outcomes(floors: dict[tuple[str, int], float], listed: int):
    """A block as a function of the champion at its entry, whose value lies within the gain
    below the highest run before. (start, end, wins, winner): an entry that the runs below
    ``start`` do not beat by more than the gain, but ``start`` does, leaves ``end``."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(_ORDER, na_position="first")
        key = (block["model_type"].iloc[0], int(block["block"].iloc[0]))
        values, gain = block["metric_value"].to_numpy(float), _gain(key[0])
        floor = floors[key]
        first = int(np.searchsorted(values, floor, "right")) if floor > -np.inf else 0
        beyond = int(np.searchsorted(values, floor + gain, "right")) + 1 if floor > -np.inf else 1
        beyond = min(beyond, len(values))
        if beyond - first > listed:
            return pd.DataFrame([(*key, None, None, None, None)], columns=_OUTCOME_NAMES)
        _, last, count = _chains(values, gain)
        at = range(first, beyond)
        ids = block["run_id"].tolist()
        lists = [values[first:beyond].tolist(), [float(values[last[i]]) for i in at], [count[i] for i in at], [ids[i] for i in at]]
        return pd.DataFrame([(*key, *lists)], columns=_OUTCOME_NAMES)

    return run


_OUTCOME_NAMES = ["model_type", "block", "start", "end", "wins", "winner"]


def _winners(entries: dict[tuple[str, int], tuple]):
    """The promoted runs of a block, from its entry: (champion's value or None, promotions
    before, the run that replaces the block's last champion or None)."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(_ORDER, na_position="first")
        kind = block["model_type"].iloc[0]
        entry, sequence, replaced_by = entries[kind, int(block["block"].iloc[0])]
        values = block["metric_value"].to_numpy(float)
        following, _, _ = _chains(values, _gain(kind))
        i = 0 if entry is None else int(np.searchsorted(values, entry + _gain(kind), "right"))
        places = []
        while i < len(values):
            places.append(i)
            i = following[i]
        won = block.iloc[places]
        ids = won["run_id"].tolist()
        out = won[["model_type", "created_at", "run_id", "metric_value"]].assign(
            sequence=range(sequence + 1, sequence + 1 + len(places))
        )
        out["replaced_by"] = pd.Series([*ids[1:], replaced_by][: len(ids)], out.index, object)
        out["is_champion"] = pd.isna(out["replaced_by"])
        return out[_PROMOTED]

    return run


def promotions(runs: DataFrame, blocks: int | None = None, listed: int = LISTED) -> DataFrame:
    """Every run that became champion, with its sequence number and the run that
    replaced it.

    The first run wins; a later run wins only if it beats the champion by more than
    the delta. That is a recurrence over the stored metrics, but a block of runs in their
    order is a function from the champion at its entry to the one at its exit, and functions
    of blocks are composed. Only runs above all before them matter, and the entry of a block
    lies within the delta below the highest run before it: so a block's function is a short
    list, where the runs rise faster than that. The driver composes one list per block. For
    blocks with over ``listed`` runs in that range it asks the block itself, which can only be
    as often as blocks promote. No task reads more than a block, a range of the log.
    """
    usable = runs.where(F.col("metric_value").isNotNull() & ~F.isnan("metric_value")).select(
        "model_type", *_ORDER, F.col("metric_value").cast("double").alias("metric_value")
    )
    spark, order = runs.sparkSession, ["model_type", *_ORDER]
    kinds = {f.name: f.dataType.simpleString() for f in usable.schema}
    fields = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    dealt = usable.repartitionByRange(*order) if blocks is None else usable.repartitionByRange(blocks, *order)
    path = scratch_dir(spark, "run-maxima")
    dealt.sortWithinPartitions(*order).mapInPandas(_maxima, f"{fields}, block int").write.parquet(path)
    maxima = spark.read.schema(f"{fields}, block int").parquet(path)

    highest = maxima.groupBy("model_type", "block").agg(F.max("metric_value").alias("top")).collect()
    floors: dict[tuple[str, int], float] = {}
    so_far: dict[str, float] = {}
    tops = {(r["model_type"], r["block"]): r["top"] for r in highest}
    for kind, block in sorted(tops):
        floors[kind, block] = so_far.get(kind, -np.inf)
        so_far[kind] = max(floors[kind, block], tops[kind, block])
    # blocks without a run above all before them change nothing
    of_block = maxima.groupBy("model_type", "block")
    outcome = f"model_type {kinds['model_type']}, block int, start array<double>, end array<double>, wins array<long>, winner array<{kinds['run_id']}>"
    lists = {
        (r["model_type"], r["block"]): r
        for r in of_block.applyInPandas(_outcomes(floors, listed), outcome).collect()
    }

    def asked(kind: str, block: int, champion: float) -> tuple:
        """(exit, wins, first winner) of one block for one entry."""
        rows = maxima.where((F.col("model_type") == kind) & (F.col("block") == block))
        won = rows.groupBy("model_type", "block").applyInPandas(
            _winners({(kind, block): (champion, 0, None)}), _promoted_schema(kinds)
        )
        r = won.agg(F.max("metric_value").alias("end"), F.count("*").alias("n"), F.min_by("run_id", "sequence").alias("id")).first()
        return r["end"], r["n"], r["id"]

    entries: dict[tuple[str, int], tuple] = {}
    promoting: dict[str, list] = {}  # (block, entry, promotions before, first winner)
    now: dict[str, tuple] = {}
    for kind, block in sorted(tops):
        champion, before = now.get(kind, (None, 0))
        if champion is not None and not tops[kind, block] > champion + _gain(kind):
            continue
        r = lists[kind, block]
        if r["start"] is None:
            end, wins, winner = asked(kind, block, champion)
        else:
            i = 0 if champion is None else int(np.searchsorted(r["start"], champion + _gain(kind), "right"))
            end, wins, winner = r["end"][i], r["wins"][i], r["winner"][i]
        promoting.setdefault(kind, []).append((block, champion, before, winner))
        now[kind] = end, before + wins
    for kind, steps in promoting.items():
        for (block, entry, before, _), after in zip(steps, [*steps[1:], None], strict=True):
            entries[kind, block] = entry, before, after and after[3]
    wanted = spark.createDataFrame([*entries] or [], f"model_type {kinds['model_type']}, block int")
    return (
        maxima.join(wanted, ["model_type", "block"], "left_semi")
        .groupBy("model_type", "block")
        .applyInPandas(_winners(entries), _promoted_schema(kinds))
    )


def _promoted_schema(kinds: dict[str, str]) -> str:
    return (
        f"model_type {kinds['model_type']}, sequence int, created_at {kinds['created_at']},"
        f"run_id {kinds['run_id']}, metric_value double, replaced_by {kinds['run_id']},"
        "is_champion boolean"
    )


def flag_champions(runs: DataFrame) -> DataFrame:
    """The log with ``is_champion`` set on the champion left after replaying all runs."""
    champions = promotions(runs).where("is_champion").select(
        "model_type", "run_id", F.lit(True).alias("_champion")
    )
    return (
        runs.drop("is_champion")
        .join(champions, ["model_type", "run_id"], "left")
        .withColumn("is_champion", F.coalesce("_champion", F.lit(False)))
        .drop("_champion")
    )


def beats_champion(model_type: str, metric: float, champion: float | None) -> bool:
    """The promotion rule for a single new run."""
    return champion is None or metric > champion + PROMOTION_DELTA[model_type]
