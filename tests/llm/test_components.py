import random

from dayscout.llm.shared import components, numbered


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)]
    edges += [(1000, i) for i in range(900, 990)] + [(5, 5), (7, 9), (9, 11), (11, 7)]
    edges += [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(180)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    rnd.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {i: root(i) for i in parent}
    assert len(got) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_numbers_are_gapless_and_in_order(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as hot").repartition(7)
    rows, total = numbered(df, [df.hot, df.id], "n", 5)
    got = sorted(rows.collect(), key=lambda r: r.n)
    assert total == 1000 and [r.n for r in got] == list(range(1000))
    assert [(r.hot, r.id) for r in got] == sorted((r.hot, r.id) for r in got)
