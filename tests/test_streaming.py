"""The stream form of the ingest gives the state of the batch form."""

import datetime as dt
import json

from pyspark.sql import functions as F

from dayscout.operators.timeseries import rolling_features
from dayscout.schemas import FEATURES, OBSERVATIONS
from dayscout.sources.scans import FEATURE_INPUTS
from dayscout.sources.store import Store
from dayscout.streaming.ingest import start_ingest


def payload(first, highs):
    days = [(first + dt.timedelta(days=i)).isoformat() for i in range(len(highs))]
    return json.dumps({"daily": {
        "time": days, "temperature_2m_max": highs, "temperature_2m_min": [0.0] * len(highs),
        "precipitation_sum": [1.0] * len(highs), "wind_speed_10m_max": [5.0] * len(highs),
    }})


def drop(folder, name, *rows):
    lines = [json.dumps({"city": c, "payload": p, "received_at": t}) for c, p, t in rows]
    (folder / name).write_text("\n".join(lines))


def run(store, tmp_path):
    q = start_ingest(store, str(tmp_path / "in"), str(tmp_path / "checkpoint"))
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store = Store(spark, str(tmp_path / "tables"))
    start = dt.date(2024, 1, 1)
    drop(tmp_path / "in", "a.json",
         ("x", payload(start, [10.0] * 10), "2024-01-01T00:00:00Z"),
         ("x", payload(start, [11.0] * 5), "2024-01-01T06:00:00Z"),
         ("y", payload(start, [20.0] * 3), "2024-01-01T00:00:00Z"))
    run(store, tmp_path)
    obs = {(r["city"], r["date"]): r["temp_max"] for r in store.read(OBSERVATIONS).collect()}
    assert len(obs) == 13 and obs[("x", start)] == 11.0
    assert obs[("x", start + dt.timedelta(days=7))] == 10.0
    # A later forecast replaces two days; features of those and the next six change.
    later = start + dt.timedelta(days=6)
    drop(tmp_path / "in", "b.json", ("x", payload(later, [30.0, 40.0]), "2024-01-06T00:00:00Z"))
    run(store, tmp_path)
    table = store.read(OBSERVATIONS)
    assert table.count() == 13
    assert table.where((F.col("city") == "x") & (F.col("date") == F.lit(later))).first()["temp_max"] == 30.0
    key = lambda r: (r["city"], r["feature_date"])
    names = [c for c in FEATURES.columns if c != "computed_at"]
    got = {key(r): r for r in store.read(FEATURES).select(*names).collect()}
    want = {key(r): r for r in rolling_features(table.select(*FEATURE_INPUTS)).select(*names).collect()}
    assert got == want


def test_files_in_reverse_order_give_the_same_state(spark, tmp_path):
    """A payload that was received earlier but arrives later replaces nothing."""
    start = dt.date(2024, 3, 1)
    files = [
        ("old", payload(start, [10.0, 11.0, 12.0]), "2024-03-01T00:00:00Z"),
        ("new", payload(start + dt.timedelta(days=1), [20.0, 21.0]), "2024-03-02T00:00:00Z"),
    ]
    states = []
    for order in (files, files[::-1]):
        root = tmp_path / order[0][0]
        (root / "in").mkdir(parents=True)
        store = Store(spark, str(root / "tables"))
        for name, text, at in order:
            drop(root / "in", f"{name}.json", ("x", text, at))
            run(store, root)
        states.append(sorted((r["date"], r["temp_max"]) for r in store.read(OBSERVATIONS).collect()))
    assert states[0] == states[1] == [(start + dt.timedelta(days=i), v) for i, v in enumerate((10.0, 20.0, 21.0))]
