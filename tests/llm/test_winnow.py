import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from dayscout.llm import winnow

LOW = 24
MASK = (1 << 64) - 1


def hashed(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def rotated(x, n):
    return ((x << n) | (x >> (64 - n))) & MASK if n else x


def fingerprint(text, k, w):
    """(hash, place) of each window's least run, rightmost of equal ones, by looking at all."""
    units = [hashed(x.encode()) for x in (text or "").lower().split()]
    if not units:
        return []
    if len(units) < k:
        acc = 0
        for u in units:
            acc = hashed(u.to_bytes(8, "little"), hashed(acc.to_bytes(8, "little")))
        return [(acc >> LOW, 0)]
    runs = []
    for i in range(len(units) - k + 1):
        value = 0
        for j in range(k):
            value ^= rotated(units[i + j], k - 1 - j)
        runs.append(value >> LOW)
    signed = [r - (1 << 40) if r >> 39 else r for r in runs]
    kept = []
    for i in range(max(1, len(runs) - w + 1)):
        window = range(i, min(i + w, len(runs)))
        least = min(signed[p] for p in window)
        place = max(p for p in window if signed[p] == least)
        if (runs[place], place) not in kept[-1:]:
            kept.append((runs[place], place))
    return kept


def parse(spelled):
    return [(int(h, 16), int(p)) for h, p in (x.split("@") for x in spelled.split())]


@pytest.mark.parametrize(("k", "w"), [(4, 8), (1, 1), (3, 5), (2, 4)])
def test_against_all_windows(spark, odd, odd_texts, k, w):
    extra = [(100, "a a a a a a a a a a a a b a a a"), (101, "q w e r t y u i o p " * 9)]
    texts = [t for _, t in [*odd_texts, *extra] if t is None or len(t) < 20_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = winnow.with_fingerprint(df, "t", "fp", k, w).select("i", winnow.spelled(F.col("fp")).alias("s"))
    assert {r.i: parse(r.s) for r in rows.collect()} == {
        i: fingerprint(t, k, w) for i, t in enumerate(texts)
    }


def test_guarantee(spark):
    """Texts that share w + k - 1 units in a row share a fingerprint."""
    shared = " ".join(f"s{i}" for i in range(winnow.W + winnow.K - 1))
    rows = [(0, " ".join(f"a{i}" for i in range(31)) + " " + shared), (1, shared + " z y x w v")]
    got = winnow.with_fingerprint(spark.createDataFrame(rows, "i int, t string"), "t", "fp")
    a, b = [set(r.h) for r in got.select(winnow.hashes(F.col("fp")).alias("h")).collect()]
    assert a & b


def test_edited_texts(spark, odd, odd_texts, none):
    got = winnow.edited_fingerprints(odd).collect()
    assert len(got) == len(odd_texts)
    key = lambda i, t: (i is None, -(i or 0), f"{'~' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}")
    chain = sorted(set(odd_texts) - {(None, None)} | {(None, None)}, key=lambda x: key(*x))
    chain = list({key(*x): x for x in chain}.values())
    texts = [t or "" for _, t in chain]
    want = {}
    for n, (i, t) in enumerate(chain):
        t, after = t or "", texts[(n + 1) % len(texts)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        sets = [{h for h, _ in fingerprint(x, winnow.K, winnow.W)} for x in (t, edited, after)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] = near
    for r in got:
        assert [r.near_edited, r.near_next] == pytest.approx(want[r.doc_id, r.n_chars, r.edited_sha256])
    assert winnow.edited_fingerprints(none).count() == 0


def test_one_document_is_its_own_next(odd):
    (r,) = winnow.edited_fingerprints(odd.where("doc_id = 12")).collect()
    assert r.near_next == 1.0 and 0 < r.near_edited < 1
