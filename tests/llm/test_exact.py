import hashlib
from collections import defaultdict

from dayscout.llm import exact


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_groups_of_equal_texts(odd, odd_texts):
    # blocks of 7 bytes: names are paired over many rounds
    got = exact.exact_duplicates(odd, block_bytes=7).collect()
    groups = defaultdict(list)
    for i, t in odd_texts:
        groups[lower(t)].append(i)
    want = sorted(
        (i or -1, max((x for x in groups[lower(t)] if x is not None), default=None) or -1, len(groups[lower(t)]),
         hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t in odd_texts
    )
    assert want == sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.text_sha256) for r in got)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(groups)  # one row of each, repeated rows too
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_names_do_not_collide_over_lengths(spark):
    rows = [(i, "ab" * n + tail) for i, (n, tail) in enumerate((n, t) for n in range(12) for t in ("", "a", "b"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.group_size for r in exact.exact_duplicates(df, block_bytes=1).collect()}
    texts = [t for _, t in rows]
    assert got == {i: texts.count(t) for i, t in rows}


def test_chunks_agree(spark, odd):
    whole = exact.identities(odd, block_bytes=16)
    cut = exact.identities(odd, block_bytes=16, chunk_bytes=64, chunk_rows=2)
    classes = lambda d: d.groupBy("n", "name").count().select("count").collect()
    assert sorted(classes(whole)) == sorted(classes(cut))


def test_rows_that_stay_keep_their_columns(odd, odd_texts, none):
    left = exact.drop_exact_duplicates(odd)
    assert left.columns == odd.columns
    texts = [lower(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {lower(t) for _, t in odd_texts}
    assert exact.drop_exact_duplicates(none).count() == exact.exact_duplicates(none).count() == 0
