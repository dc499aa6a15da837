import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dayscout.llm import conversation_repair as repair
from dayscout.llm import queries

RIGHT = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def least(rows):
    """Every sequence of edits of (initial, must go, truncated) rows, tried one by one."""
    found = []
    for ops in itertools.product(*["D" if gone else "DKR" for _, gone, _ in rows]):
        for adds in itertools.product(range(3), repeat=len(rows) + 1):
            cost, audit, roles = 0, "", [""]
            for (initial, _, cut), op, n in zip([*rows, ("", False, False)], [*ops, ""], adds, strict=True):
                cost, audit = cost + 3 * n, audit + "I" * n + op
                roles = [r + "".join(x) for r in roles for x in itertools.product("ua", repeat=n)]
                cost += {"D": 4, "K": 3 * cut, "R": 3 + 3 * cut, "": 0}[op]
                roles = [r + x for r in roles for x in {"K": initial, "R": "ua"}.get(op, [""])] if op else roles
            if any(RIGHT.fullmatch(r) for r in roles):
                found.append((cost, audit))
    return min(found)


def walk(rows):
    """Least (cost, audit) by states, row by row."""
    ways = {0: (0, "")}

    def inserted():
        for p, q in ((0, 2), (1, 2), (3, 2), (2, 3), (3, 2)):
            if p in ways:
                ways[q] = min(ways.get(q, (1 << 60, "")), (ways[p][0] + 3, ways[p][1] + "I"))

    inserted()
    for initial, gone, cut in rows:
        new = {}
        for p, (c, a) in ways.items():
            options = [(p, 4, "D")]
            if not gone:
                options += [(q, 3 * cut, "K") for (x, i), q in repair.STEP.items() if (x, i) == (p, initial)]
                options += [(q, 3 + 3 * cut, "R") for (x, i), q in repair.STEP.items() if x == p and i != "s"]
            for q, more, letter in options:
                new[q] = min(new.get(q, (1 << 60, "")), (c + more, a + letter))
        ways = new
        inserted()
    return min(ways[q] for q in (0, 3) if q in ways)


def random_rows(rnd, n):
    return [(rnd.choice("suuaaa?"), rnd.random() < 0.15, rnd.random() < 0.3) for _ in range(n)]


def cells_of(rows):
    kinds = np.array(["sua?".index(i) * 3 + (2 if gone else cut) for i, gone, cut in rows])
    starts = np.arange(0, len(rows), repair.BLOCK)
    numbers = repair._block_cells(kinds, starts, np.minimum(repair.BLOCK, len(rows) - starts))
    audits = [repair._audits(line) for line in numbers]
    spans = [
        [
            None if numbers[c, k] >= repair._NONE else (int(numbers[c, k]) >> 54, audits[c][k])
            for c in range(len(repair.CELLS))
        ]
        for k in range(len(starts))
    ]
    return spans


def test_all_short_conversations_against_every_edit():
    rows = [("s", False, False), ("u", False, True), ("a", False, False), ("u", False, False), ("?", True, False), ("a", False, True)]
    three = random.Random(7).sample([*itertools.product(rows, repeat=3)], 40)
    for n in (1, 2, 3):
        for some in itertools.product(rows, repeat=n) if n < 3 else three:
            assert repair.best(repair.whole(cells_of(list(some)))) == least(list(some))


def test_long_conversations_against_a_walk():
    rnd = random.Random(1)
    for n in [*range(1, 40), 64, 65, 200, 401]:
        for _ in range(6):
            rows = random_rows(rnd, n)
            assert repair.best(repair.whole(cells_of(rows))) == walk(rows)


def test_any_bracket_gives_the_same_cells():
    rnd = random.Random(2)
    for _ in range(200):
        rows = random_rows(rnd, rnd.randint(2, 30))
        cut = rnd.randint(1, len(rows) - 1)
        both = repair.joined(repair.whole(cells_of(rows[:cut])), repair.whole(cells_of(rows[cut:])))
        assert both == repair.whole(cells_of(rows))


def test_a_full_chart_of_deletions_fits_a_number():
    rows = [("?", True, True)] * repair.BLOCK
    for cell, at in zip(cells_of(rows)[0], repair.CELLS, strict=True):
        assert cell is None or len(cell[1]) <= 24, at


def brute(rows):
    """The query over (conv_id, turn, role, text) rows, in plain Python."""
    out = {}
    groups = {r[0]: [] for r in rows}
    for c, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        groups[c] += [(turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    for c, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds, blank, duplicate, truncated = set(), [], 0, 0, 0
        for _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            is_blank, again = not body, (role, text) in seen
            cut = not is_blank and not again and body[-1] not in ".!?"
            blank, duplicate, truncated = blank + is_blank, duplicate + (again and not is_blank), truncated + cut
            kinds.append((role[:1], is_blank or again, cut))
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds))
        cost, audit = walk(kinds) if own else (0, "")
        lines, state, left = [], 0, iter(own)
        for k in audit:
            row = next(left) if k != "I" else None
            if k == "D":
                continue
            role = row[1] if k == "K" else "assistant" if state == 2 else "user"
            state = repair.STEP[state, role[0]]
            lines.append(f"{role}:{row[2] if row else ''}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (c, gaps, blank, duplicate, truncated, illegal, cost, audit, digest)
    return sorted(out.values(), key=str)


def answers(df):
    report = repair.repair_report(repair.damage(df), "copies")
    return sorted((tuple(r) for r in report.collect()), key=str)


def test_query_equals_brute_force_and_sql(spark, folder):
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    own = queries.op11_conversation_repair(spark, folder)
    got = sorted((tuple(r) for r in own.collect()), key=str)
    assert got == brute(rows)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    said = db.sql(queries.ORACLES["op11_conversation_repair"])
    assert said.columns == own.columns and sorted(said.fetchall(), key=str) == got


@pytest.fixture(scope="module")
def odd_turns():
    rnd = random.Random(4)
    texts = [None, "", " \n\t ", "Yes.", "yes", "Why?  ", "no\x85", "x" * 40_000, "é日本!", "a.\nb"]
    roles = [None, "", "system", "user", "assistant", "tool", "student", "ångström"]
    rows = [
        (rnd.choice([None, -3, 5, 6, 7, 1 << 60]), rnd.choice([None, 0, 1, 2, 3, 9, 40]), rnd.choice(roles), rnd.choice(texts))
        for _ in range(400)
    ]
    rows += [(c, t, ("user", "assistant")[t % 2], f"Turn {t}.") for c in range(100, 160) for t in range(rnd.randint(1, 30))]
    rows += [(99, t, rnd.choice(roles), rnd.choice(["ok", f"text {t}", f"Text {t}!"])) for t in range(3000)]
    return rows


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_odd_rows_and_a_hot_conversation_over_many_tasks(spark, odd_turns, parts):
    df = spark.createDataFrame(odd_turns, SCHEMA).withColumns(
        {c: F.lit(c) for c in ("copies", "audit", "_c", "rows", "cost", "_head")}
    )
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        assert answers(df) == brute(odd_turns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repaired_turns_are_a_right_conversation(spark, odd_turns):
    damaged = repair.damage(spark.createDataFrame(odd_turns, SCHEMA))
    report = {r.conv_id: r.repaired_sha256 for r in repair.repair_report(damaged, "copies").collect()}
    turns = {c: [] for c in report}
    for r in sorted(repair.repaired(damaged, "copies").collect(), key=lambda r: r.place):
        assert r.place == len(turns[r.conv_id])
        turns[r.conv_id].append((r.role, r.text))
    for c, own in turns.items():
        assert RIGHT.fullmatch("".join(role[0] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in own).encode()).hexdigest() == report[c]


def test_an_undamaged_conversation_stays(spark):
    rows = [(1, 0, "system", "Be short."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello.")]
    got = repair.repair_report(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.cost, got.audit, got.illegal, got.gaps) == (0, "KKK", 0, 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert answers(df) == [] and repair.repaired(df).count() == 0 and repair.parse(df).count() == 0
