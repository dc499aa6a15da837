import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from dayscout.llm import conversation_trie as trie
from dayscout.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The nodes over (conv_id, turn, role, text) rows, by whole rebuilt texts."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        turns = own.get(base, [])[:h] + ts[h:]
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), [[], []])[0].append(c)
        nodes[tuple(turns)][1].append(c)
    out = []
    for path, (members, ends) in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)]
        words = lambda p: len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        out.append((
            min(members), len(path), min(nodes[path[:-1]][0]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in below), len(childless),
            sum((len(nodes[p][0]) - 1) * words(p) for p in below),
            hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_fingerprints_are_a_monoid():
    rnd, b = random.Random(1), trie.base(3)
    some = [(rnd.randint(0, 2000), rnd.randrange(trie.P)) for _ in range(30)]
    for x, y, z in zip(some, some[1:], some[2:], strict=False):
        left = trie.combined(b, trie.combined(b, x, y), z)
        assert left == trie.combined(b, x, trie.combined(b, y, z))
        assert trie.combined(b, (0, 0), x) == x == trie.combined(b, x, (0, 0))


def test_query_equals_brute_force_and_sql(spark, folder):
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    own = queries.op12_prefix_trie(spark, folder)
    got = found(own)
    assert own.columns == COLUMNS and got == brute(rows)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    said = db.sql(queries.ORACLES["op12_prefix_trie"])
    assert said.columns == COLUMNS and sorted(said.fetchall(), key=str) == got


@pytest.fixture(scope="module")
def odd_turns():
    rnd = random.Random(4)
    roles, texts = [None, "", "user", "assistant"], [None, "", " \n", "a b", "a  b", "é日本 x", "1:a"]
    rows = [(rnd.choice([None, *range(-45, 90)]), rnd.choice([None, 0, 1, 2, 3]), rnd.choice(roles), rnd.choice(texts)) for _ in range(250)]
    rows += [(c, t, "user", f"turn {t}") for c in (100, 101, 102, 119, 125) for t in range(rnd.choice([2, 5, 6]))]
    rows += [(140, t, "user", f"long {t // 3}") for t in range(120)] * 2
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(5)]  # one text for most
    rows += [(1 << 61, 0, "user", "x" * 50_000)]
    return rows


@pytest.mark.parametrize("parts", [1, 6, 30])
def test_odd_rows_over_many_tasks(spark, odd_turns, parts):
    df = spark.createDataFrame(odd_turns, SCHEMA).withColumns(
        {c: F.lit(c) for c in ("depth", "f1", "place", "part", "base", "words", "_head", "n_convs")}
    )
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        assert found(trie.prefix_trie(df)) == brute(odd_turns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_other_heads_and_steps(spark, odd_turns):
    df = spark.createDataFrame(odd_turns, SCHEMA)
    nodes = trie.prefix_trie(df, every=7, heads=2).collect()
    root = next(r for r in nodes if r.depth == 0)
    assert root.n_convs == len({r[0] for r in odd_turns if r[0] is not None})
    assert root.n_leaves == sum(r.n_children == 0 for r in nodes)


def test_a_reference_leads_to_the_last_turn(spark, odd_turns):
    stored = {}
    for c, turn, role, text in odd_turns:
        if c is not None:
            stored.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    stored = {c: sorted(ts) for c, ts in stored.items()}
    for r in trie.prefix_trie(spark.createDataFrame(odd_turns, SCHEMA)).collect():
        assert r.depth == 0 or 0 < r.ref_turn <= len(stored[r.ref_conv_id])


def test_a_collision_is_seen_and_another_seed_taken(spark, odd_turns, monkeypatch):
    real, seeds = trie._turns, []

    def weak(conversations, seed):
        seeds.append(seed)
        out = real(conversations, seed)
        return out if seed else out.withColumns({"d1": F.lit(5).cast("long"), "d2": F.length("text").cast("long")})

    monkeypatch.setattr(trie, "_turns", weak)
    assert found(trie.prefix_trie(spark.createDataFrame(odd_turns, SCHEMA))) == brute(odd_turns)
    assert {0, 1} <= set(seeds)


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = next(c for c in range(1, 100) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [(alone, 0, "user", "gone")]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
