"""The versioned store: what is published, what is rewritten, what is refused."""

import datetime as dt
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayscout.operators import writes
from dayscout.operators.runlog import current_champion
from dayscout.schemas import MODEL_RUNS, OBSERVATIONS, POIS, PROFILE_SCORES, PROFILES, RECOMMENDATIONS
from dayscout.sources import scans
from dayscout.sources.dims import profiles_table
from dayscout.sources.files import Files, clean_scratch, scratch_dir
from dayscout.sources.store import ConflictError, ConstraintError, Store

DAYS = [dt.date(2024, 1, i) for i in range(1, 21)]


def newest():
    return [F.col("n").desc()]



def observations(spark, rows):
    return spark.createDataFrame(rows, "city string, date date, temp_max double, n int")


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def files(store, table=OBSERVATIONS):
    return [f.path for f in store.snapshot().state(table).files]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"))


@pytest.fixture
def three_days(spark, store):
    """One file per day."""
    for d in DAYS[:3]:
        store.append(observations(spark, [("a", d, 1.0, 1), ("b", d, 2.0, 1)]), OBSERVATIONS)
    return store


def test_upsert_rewrites_only_files_that_hold_its_keys(spark, three_days):
    before = files(three_days)
    batch = [("a", DAYS[1], 9.0, 1), ("a", DAYS[1], 8.0, 2), ("c", DAYS[2], 4.0, 1), ("a", DAYS[7], 5.0, 1)]
    three_days.upsert(observations(spark, batch), OBSERVATIONS, newest())
    after = files(three_days)
    assert before[0] in after and before[2] in after and before[1] not in after
    found = got(three_days.read(OBSERVATIONS), "city", "date", "temp_max")
    assert found == [
        ("a", DAYS[0], 1.0), ("a", DAYS[1], 8.0), ("a", DAYS[2], 1.0), ("a", DAYS[7], 5.0),
        ("b", DAYS[0], 2.0), ("b", DAYS[1], 2.0), ("b", DAYS[2], 2.0), ("c", DAYS[2], 4.0),
    ]
    assert three_days.read(OBSERVATIONS).columns == OBSERVATIONS.columns


def test_insert_ignore_rewrites_nothing(spark, three_days):
    before = files(three_days)
    three_days.insert_ignore(
        observations(spark, [("a", DAYS[0], 7.0, 1), ("z", DAYS[0], 3.0, 1)]), OBSERVATIONS, newest()
    )
    assert set(before) < set(files(three_days))
    assert got(three_days.read(OBSERVATIONS).where("date = '2024-01-01'"), "city", "temp_max") == [
        ("a", 1.0), ("b", 2.0), ("z", 3.0)]


def test_reads_push_dates_down_and_prune_files(spark, three_days):
    scan = scans.observations_lookback(three_days.read(OBSERVATIONS), DAYS[4], 3)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan.split("PushedFilters")[1]
    assert "wind_gusts_max" not in plan.split("ReadSchema")[1]
    one = three_days.read_range(OBSERVATIONS, DAYS[1], DAYS[1])
    assert len(one.inputFiles()) == 1 and got(one, "city") == [("a",), ("b",)]
    assert three_days.read_range(OBSERVATIONS, DAYS[9]).count() == 0


def test_a_job_lost_before_its_rename_changes_nothing(spark, three_days, monkeypatch):
    before, rows = files(three_days), got(three_days.read(OBSERVATIONS), *OBSERVATIONS.columns[:3])

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(Files, "publish", lost)
    for write in (
        lambda: three_days.upsert(observations(spark, [("a", DAYS[0], 9.0, 1)]), OBSERVATIONS, newest()),
        lambda: three_days.update(OBSERVATIONS, lambda old: old.where("city = 'a'")),
        lambda: three_days.delete_where(OBSERVATIONS, F.col("city") == "b"),
    ):
        with pytest.raises(KeyboardInterrupt):
            write()
    assert files(three_days) == before
    assert got(three_days.read(OBSERVATIONS), *OBSERVATIONS.columns[:3]) == rows
    monkeypatch.undo()
    left = {f.below for f in Files(spark).list(three_days.path(OBSERVATIONS), deep=True) if "/part-" in f.below}
    assert set(before) < left
    assert three_days.clean(older_than=-60) > 0
    left = {f.below for f in Files(spark).list(three_days.path(OBSERVATIONS), deep=True) if "/part-" in f.below}
    assert left == set(before) and got(three_days.read(OBSERVATIONS), *OBSERVATIONS.columns[:3]) == rows


def test_readers_beside_an_upsert_see_old_or_new(spark, three_days):
    old = set(got(three_days.read(OBSERVATIONS), "city", "date", "temp_max"))
    new = {(c, d, t + 10) for c, d, t in old}
    seen, done = [], threading.Event()

    def reader():
        while not done.is_set():
            seen.append(set(got(three_days.read(OBSERVATIONS), "city", "date", "temp_max")))

    readers = [threading.Thread(target=reader) for _ in range(2)]
    for r in readers:
        r.start()
    rows = [(c, d, t, 1) for c, d, t in new]
    three_days.upsert(observations(spark, rows), OBSERVATIONS, newest())
    done.set()
    for r in readers:
        r.join()
    assert old in seen and all(s in (old, new) for s in seen)
    assert set(got(three_days.read(OBSERVATIONS), "city", "date", "temp_max")) == new


def test_a_pinned_version_stays(spark, three_days):
    pinned, frame = three_days.snapshot(), three_days.read(OBSERVATIONS)
    three_days.update(OBSERVATIONS, lambda old: old.where("city = 'a'"))
    assert frame.count() == 6 == pinned.read(OBSERVATIONS).count()
    assert three_days.read(OBSERVATIONS).count() == 3
    assert three_days.snapshot(1).read(OBSERVATIONS).count() == 2
    with pytest.raises(ValueError):
        three_days.snapshot(99)


def test_a_transaction_shows_all_tables_or_none(spark, store):
    scores = spark.createDataFrame(
        [("a", DAYS[0], "leisure", 1.0)], "city string, feature_date date, profile_name string, comfort_score double"
    )
    with pytest.raises(RuntimeError), store.transaction() as t:
        t.append(profiles_table(spark), PROFILES)
        t.append(scores, PROFILE_SCORES)
        assert t.read(PROFILE_SCORES).count() == 1
        raise RuntimeError
    assert store.versions() == [] and store.read(PROFILES).count() == 0
    with store.transaction() as t:
        t.append(profiles_table(spark), PROFILES)
        t.append(scores, PROFILE_SCORES)
        assert store.read(PROFILES).count() == 0
    assert store.versions() == [1] and store.read(PROFILE_SCORES).count() == 1
    with store.transaction() as t:
        t.delete_where(PROFILES, F.col("profile_name") == "leisure")
        t.delete_orphans(PROFILE_SCORES, t.read(PROFILES), ["profile_name"])
    assert store.read(PROFILE_SCORES).count() == 0


def test_the_second_of_two_writers_of_a_table_is_refused(spark, three_days):
    rows = observations(spark, [("a", DAYS[9], 1.0, 1)])
    with pytest.raises(ConflictError), three_days.transaction() as t:
        t.append(rows, OBSERVATIONS)
        three_days.append(observations(spark, [("b", DAYS[9], 1.0, 1)]), OBSERVATIONS)
    assert got(three_days.read(OBSERVATIONS).where("date > '2024-01-05'"), "city") == [("b",)]
    with three_days.transaction() as t:  # writers of other tables do not meet
        t.append(rows, OBSERVATIONS)
        three_days.append(profiles_table(spark), PROFILES)
    assert three_days.read(OBSERVATIONS).count() == 8 and three_days.read(PROFILES).count() > 0


@pytest.mark.parametrize(
    "rows, said",
    [
        ([("x", DAYS[0], 1.0, 1), ("x", DAYS[0], 2.0, 2)], "repeated key"),
        ([("a", DAYS[0], 1.0, 1)], "repeated key"),
        ([(None, DAYS[0], 1.0, 1)], "null city"),
    ],
)
def test_rows_against_the_rules_are_refused_by_the_write(spark, three_days, rows, said):
    before = files(three_days), three_days.versions()
    with pytest.raises(ConstraintError, match=said):
        three_days.append(observations(spark, [("ok", DAYS[5], 1.0, 1), *rows]), OBSERVATIONS)
    assert (files(three_days), three_days.versions()) == before


def test_unknown_parents_are_refused(spark, store):
    columns = "city string, feature_date date, profile_name string, comfort_score double"
    score = lambda profile: spark.createDataFrame([("a", DAYS[0], profile, 1.0)], columns)
    store.append(profiles_table(spark), PROFILES)
    store.append(score("leisure"), PROFILE_SCORES)
    for write in (store.append, lambda rows, t: store.upsert(rows, t, [F.col("city")])):
        with pytest.raises(ConstraintError, match="unknown scoring_profiles"):
            write(score("nobody"), PROFILE_SCORES)
    assert got(store.read(PROFILE_SCORES), "profile_name") == [("leisure",)]


def test_a_new_column_has_its_default_in_old_files(spark, store):
    names = [n for n in RECOMMENDATIONS.columns if n not in ("profile_name", "rank")]
    before = replace(
        RECOMMENDATIONS,
        schema=StructType([RECOMMENDATIONS.schema[n] for n in names]),
        key=("recommendation_date", "city"),
    )
    row = lambda c: spark.createDataFrame([(DAYS[0], c, 50.0)], "recommendation_date date, city string, comfort_score_pred double")
    store.append(row("a"), before)
    old = files(store, RECOMMENDATIONS)
    store.add_column(RECOMMENDATIONS, "profile_name", "string", "leisure")
    store.add_column(RECOMMENDATIONS, "profile_name", "string", "again")
    assert files(store, RECOMMENDATIONS) == old
    store.append(row("b"), before)  # a writer that does not know the column
    store.append(row("c").withColumn("profile_name", F.lit("skier")), RECOMMENDATIONS)
    relaxed = replace(RECOMMENDATIONS, schema=StructType([f if f.name != "profile_name" else replace_null(f) for f in RECOMMENDATIONS.schema]))
    store.append(row("d").withColumn("profile_name", F.lit(None).cast("string")), relaxed)
    found = got(store.read(RECOMMENDATIONS).fillna("null", ["profile_name"]), "city", "profile_name")
    assert found == [("a", "leisure"), ("b", "leisure"), ("c", "skier"), ("d", "null")]
    assert store.read(RECOMMENDATIONS).where("profile_name = 'leisure'").count() == 2
    assert store.read(RECOMMENDATIONS).where("rank IS NULL").count() == 4
    store.compact(relaxed)
    assert got(store.read(relaxed).fillna("null", ["profile_name"]), "city", "profile_name") == found


def replace_null(f):
    return type(f)(f.name, f.dataType, True)


def test_compaction_keeps_rows_and_merges_small_files(spark, store):
    for d in DAYS[:6]:
        store.append(observations(spark, [(c, d, 1.0, 1) for c in "abc"]), OBSERVATIONS)
    rows = got(store.read(OBSERVATIONS), "city", "date")
    assert store.compact(OBSERVATIONS) == 6 and len(files(store)) == 1
    assert got(store.read(OBSERVATIONS), "city", "date") == rows and len(rows) == 18
    kept = [(r["date"], r["city"]) for r in store.read(OBSERVATIONS).collect()]
    assert kept == sorted(kept) and store.compact(OBSERVATIONS) == 0


def test_retention_drops_whole_files_unread(spark, three_days):
    later = observations(spark, [("a", d, 1.0, 1) for d in DAYS[3:8]])
    three_days.append(later, OBSERVATIONS)
    before = files(three_days)
    assert three_days.drop_before(OBSERVATIONS, DAYS[2]) == 4
    assert files(three_days) == before[2:]
    assert three_days.drop_before(OBSERVATIONS, DAYS[5]) == 4
    assert got(three_days.read(OBSERVATIONS), "date") == [(d,) for d in DAYS[5:8]]


def test_tables_without_dates(spark, store):
    names = "city string, hotel_name string, hotel_type string, stars int"
    rows = lambda *r: spark.createDataFrame(list(r), names)
    store.upsert(rows(("a", "x", "hotel", 3), ("a", "y", "hotel", 1)), POIS, [F.col("stars").desc()])
    store.upsert(rows(("a", "y", "hostel", 2), ("b", "z", "hotel", 5)), POIS, [F.col("stars").desc()])
    assert got(store.read(POIS), "hotel_name", "hotel_type", "stars") == [
        ("x", "hotel", 3), ("y", "hostel", 2), ("z", "hotel", 5)]
    store.upsert_columns(rows(("a", "x", "inn", 4), ("c", "w", "inn", 1)), POIS, ["stars"], [F.col("stars")])
    assert got(store.read(POIS), "hotel_name", "hotel_type", "stars")[:2] == [("w", "inn", 1), ("x", "hotel", 4)]
    parents = spark.createDataFrame([("a",)], "city string")
    store.update(POIS, lambda old: writes.cascade_delete(old, parents, ["city"]))
    assert got(store.read(POIS), "hotel_name") == [("x",), ("y",)]
    assert store.update_where(POIS, F.col("stars") == 99, {"stars": F.lit(0)}) == 0


def test_an_update_rewrites_only_files_with_such_rows(spark, store):
    runs = lambda *ids: spark.createDataFrame(
        [(DAYS[0], i, "kmeans", "silhouette_score", 0.1 * i, i == 2) for i in ids],
        "run_date date, run_id long, model_type string, metric_name string, metric_value double, is_champion boolean",
    ).withColumn("created_at", F.lit(DAYS[0]).cast("timestamp"))
    store.append(runs(0, 1, 1), MODEL_RUNS)  # a log may repeat a key
    store.append(runs(2, 3), MODEL_RUNS)
    before = files(store, MODEL_RUNS)
    assert current_champion(store.read(MODEL_RUNS)).first()["run_id"] == 2
    assert store.update_where(MODEL_RUNS, F.col("run_id") == 2, {"is_champion": F.lit(False)}) == 1
    assert current_champion(store.read(MODEL_RUNS)).count() == 0
    assert len(set(before) & set(files(store, MODEL_RUNS))) == 1 and store.read(MODEL_RUNS).count() == 5


def test_empty_batches(spark, three_days):
    none = observations(spark, [])
    before = three_days.read(OBSERVATIONS).count()
    for write in (three_days.append, lambda r, t: three_days.upsert(r, t, newest()), lambda r, t: three_days.insert_ignore(r, t, newest())):
        write(none, OBSERVATIONS)
    assert three_days.read(OBSERVATIONS).count() == before


def test_scratch_folders_go(spark):
    path = scratch_dir(spark, "test")
    spark.range(3).write.parquet(path)
    assert Files(spark).exists(path)
    clean_scratch()
    assert not Files(spark).exists(path)
