import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayscout.llm import quality


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose, and shouted or repetitive junk; a third of it labelled, some of it wrongly."""
    rnd = random.Random(8)
    words = [a + b for a in ("ta", "mo", "ri", "se", "lu") for b in ("", "n", "ra", "ke", "st")]
    rows = []
    for i in range(3000):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(15, 200)))
        good = rnd.random() < 0.8
        if not good:
            text = text.upper().replace(" ", "!! ") if i % 2 else " ".join([text[:9]] * 40)
        rows.append((i, text, int(good)))
    truth = {i: g for i, _, g in rows}
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows if i % 3 == 0], "doc_id long, quality int")
    return docs, labels, truth


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    got = quality.score_quality(docs, labels).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.97
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert kept == {r.doc_id for r in got if r.predicted}


def test_only_trusted_positives_teach(corpus):
    """Neither labels 0 nor held-out labels change anything."""
    docs, labels, _ = corpus
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    taught = labels.where("quality = 1").where(~held)
    a = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.score_quality(docs, taught).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_prior(corpus):
    docs, labels, truth = corpus
    rows = quality._feature_table(docs, labels, "doc_id", "text", 0).select("x", "positive")
    assert quality.fit(rows)[3] == pytest.approx(np.mean(list(truth.values())), abs=0.08)


def test_gradient_is_that_of_the_risk(corpus):
    docs, labels, _ = corpus
    rows = quality._feature_table(docs, labels, "doc_id", "text", 0).select("x", "positive")
    _, mean, scale, _ = quality.fit(rows, steps=1)
    risk = quality.Risk(rows, mean, scale, 1e-3)
    rnd = np.random.default_rng(1)
    for prior in (0.7, 0.99):  # with the second, the inner term is cut off at zero
        w = rnd.normal(0, 0.3, quality.WIDTH + 1)
        value, gradient, _ = risk.at(w, prior)
        d = rnd.normal(0, 1, len(w))
        low, high = (risk.at(w + s * 1e-5 * d, prior)[0] for s in (-1, 1))
        assert (high - low) / 2e-5 == pytest.approx(gradient @ d, rel=1e-3, abs=1e-6)


def test_odd_rows(spark, odd, odd_texts, none):
    labels = spark.createDataFrame([(9, 1), (12, 1), (12, None), (4, 0), (None, 1), (6, 1), (6, 0)], "doc_id long, quality int")
    got = quality.score_quality(odd, labels).collect()
    assert len(got) == len(odd_texts) and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert {r.score for r in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(none, labels).count() == quality.keep_good(none, labels).count() == 0


def test_best_bin():
    positive = np.array([0, 10, 90, 900])
    assert quality.best_bin(positive * 7 + np.array([3000, 0, 0, 0]), positive) == pytest.approx(0.7, abs=0.01)
