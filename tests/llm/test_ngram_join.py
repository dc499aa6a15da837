import itertools
import random
import re

import numpy as np
import pytest

from dayscout.llm import ngram_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    flat = [(i, s) for i, own in sets.items() for s in own if s]
    for (i, x), (j, y) in itertools.combinations(flat, 2):
        if 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return sorted((i, len(shingles(t)), root(i)) for i, t in rows)


def found(df, **parameters):
    return sorted(tuple(r) for r in ngram_join.similar_groups(df, **parameters).collect())


def near_copies(seed):
    """Groups whose members drift apart, over few words, so that many shingles are common."""
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(25)]
    chorus = [rnd.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 5, 6, 8, 11, 25, 60, 140]))]
        if rnd.random() < 0.4:
            base += chorus
        for _ in range(rnd.choice([1, 2, 4, 20])):
            words = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 5])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append((7 * len(rows) + 3, " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "parameters"), [(1, {"frequent": 1, "block": 3000}), (2, {"frequent": 4}), (3, {"percent": 60})])
def test_against_all_pairs(spark, seed, parameters):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, **parameters) == brute(rows, parameters.get("percent", 75))


def test_odd_rows(odd, odd_texts, none):
    known = [(i, t) for i, t in odd_texts if i is not None]
    assert found(odd.where("doc_id is not null")) == brute(known, 75)
    lost = ngram_join.similar_groups(odd).where("doc_id is null").collect()
    assert sorted((r.n_shingles, r.component_id) for r in lost) == [(0, None), (36, None)]
    left = ngram_join.one_of_each_group(odd)
    assert left.columns == odd.columns
    roots = {i for i, _, c in brute(known, 75) if i == c}
    assert {r.doc_id for r in left.collect()} == roots | {None}
    assert ngram_join.similar_groups(none).count() == ngram_join.one_of_each_group(none).count() == 0


def test_large_ids(spark):
    big = 2**62 + 1
    rows = [(big, "a b c d e f"), (big + 1, "A b c d e f"), (None, "a b c d e f")]
    got = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(big, big), (big + 1, big), (None, None)}


def test_similar_sets_share_a_signature():
    """For any two sets over the threshold, at any cut between rare and frequent."""
    rnd = np.random.default_rng(4)
    for _ in range(400):
        n = int(rnd.integers(1, 90))
        universe = np.sort(rnd.choice(10_000, n + 40, replace=False)).astype(np.int64)
        counts = np.sort(rnd.integers(2, 60, n + 40))
        x = np.sort(rnd.choice(n + 40, n, replace=False))
        y = x.copy()
        swap = int(rnd.integers(0, max(1, n // 6) + 1))
        y[rnd.choice(n, swap, replace=False)] = rnd.choice(np.setdiff1d(np.arange(n + 40), x), swap, replace=False)
        y = np.sort(y[: max(1, n - int(rnd.integers(0, 3)))])
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        for frequent in (1, 10, 30, 100):
            a, b = (ngram_join.signatures(universe[s], counts[s], len(s), 75, frequent) for s in (x, y))
            assert set(a) & set(b)


def test_blocks_of_the_verification():
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 40, rnd.integers(1, 30))) for _ in range(60)]
    sizes = np.array([len(s) for s in sets], np.float32)
    near = lambda i, j: len(np.intersect1d(sets[i], sets[j])) * 100 >= 50 * len(np.union1d(sets[i], sets[j]))
    for split in (None, 20):
        label = np.arange(60)
        for _ in range(60):
            for i, j in itertools.combinations(range(60), 2):
                if (split is None or i < split <= j) and near(i, j):
                    label[[i, j]] = min(label[i], label[j])
        assert (ngram_join.linked(sets, sizes, 50, split) == label).all()
