"""Registered queries against their SQL, and the pipeline against brute force."""

import itertools
import re


import corpus_pipeline
import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from dayscout.llm import quality
from dayscout.llm.queries import ORACLES, QUERIES, table, tokenizer_path
from test_exact import lower
from test_ngram_join import shingles
from test_packing import best_fit_decreasing, check
from test_pii import spans


def test_thirteen_queries():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_against_sql(spark, folder, key):
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cur = con.execute(ORACLES[key])
    names = [c[0] for c in cur.description]
    want = sorted(map(str, cur.fetchall()))
    got = QUERIES[key](spark, folder).select(*names).collect()
    assert want == sorted(str(tuple(r)) for r in got)


def test_pipeline_against_brute_force(spark, folder):
    documents = table(spark, folder, "documents")
    scored = quality.score_quality(documents, table(spark, folder, "labels"))
    good = {r.doc_id for r in scored.collect() if r.predicted}
    texts = {r.doc_id: r.text or "" for r in documents.collect() if r.doc_id in good}
    last = {}
    for i, t in sorted(texts.items()):
        last[lower(t)] = i
    texts = {i: texts[i] for i in last.values()}
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    for _ in range(8):
        for i, j in itertools.combinations(sorted(texts), 2):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[i] = root[j] = min(root[i], root[j])
    texts = {i: t for i, t in texts.items() if root[i] == i}
    for kind, (pattern, confirm) in KINDS.items():
        for i, t in texts.items():
            texts[i] = re.sub(pattern, lambda m, k=kind, c=confirm: f"<{k}>" if c(m.group()) else m.group(), t)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids_of = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts)
    made = check(rows, ids_of, 1024)
    assert made == best_fit_decreasing([r.length for r in rows], 1024)


def _confirmed(kind):
    return lambda match: bool(spans(match)) and any(k == kind and (a, b) == (0, len(match)) for k, a, b in spans(match))


KINDS = {
    "EMAIL": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", _confirmed("email")),
    "IP": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", _confirmed("ip")),
    "CARD": (r"[0-9](?:[\x20-]?[0-9])+", _confirmed("card")),
    "PHONE": (r"\+[0-9][\x20().0-9-]+[0-9]", _confirmed("phone")),
}


def test_stages_return_documents(spark, folder):
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes, name
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "PII", "best-fit packing",
    ]


def test_stages_on_odd_rows_and_none(spark, odd, odd_texts, none, folder):
    """Null, empty, blank, repeated and very long texts, clashing columns, and no rows."""
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == odd.columns
        kept = docs.select("doc_id", "text").collect()
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
        assert {r.doc_id for r in pieces} == {r.doc_id for r in kept}
        if not kept:
            assert not pieces
            continue
        texts = [lower(r.text) for r in kept]
        assert len(texts) == len(set(texts)) and {"", "one", "  \n\t "} <= set(texts)
