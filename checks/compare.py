"""Run registered queries next to their oracles and compare the results.

    python -m checks.compare [--dir FOLDER] [--times] [key ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    import tempfile

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dayscout-checks")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


SPARK_SECONDS: dict[str, float] = {}


def _cell(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _kind(v) -> str:
    return type(v).__name__


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in data),
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


def compare(spark, con, folder: str, key: str) -> str:
    """Empty when equal; otherwise what differs."""
    df = QUERIES[key](spark, folder)
    got_columns = df.columns
    start = time.time()
    got = [tuple(r) for r in df.collect()]
    SPARK_SECONDS[key] = time.time() - start
    if key not in ORACLES:
        return "" if got else "no rows"
    cur = con.execute(ORACLES[key])
    want_columns = [x[0] for x in cur.description]
    want = cur.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} vs {sorted(want_columns)}"
    if len(got) != len(want):
        return f"row count {len(got)} vs {len(want)}"
    a, b = rows_of(got_columns, got), rows_of(want_columns, want)
    names = sorted(got_columns)
    for i, name in enumerate(names):
        ka = {_kind(r[i]) for r in a if r[i] is not None}
        kb = {_kind(r[i]) for r in b if r[i] is not None}
        if ka and kb and ka != kb:
            return f"type of {name}: {ka} vs {kb}"
    differing = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0]} (columns {names})"
    return "" if got else "equal but empty"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark, con = session(), connect(args.dir)
    bad = 0
    for key in args.keys or QUERIES:
        start = time.time()
        try:
            said = compare(spark, con, args.dir, key)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            said = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(said)
        oracle = "E" if key in ORACLES else "R"
        print(f"{'FAIL' if said else 'ok  '} {oracle} {key} {time.time() - start:.1f}s (collect {SPARK_SECONDS.get(key, 0):.1f}s) {said}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
