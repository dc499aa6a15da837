from collections import Counter

import numpy as np
import pytest

from dayscout.llm import pieces
from dayscout.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PATH, 1.0)


def paths(text, p):
    """Every segmentation of a word with its weight."""
    if not text:
        return [((), 1.0)]
    return [
        ((p.ids[text[:n]], *rest), p.weights[p.ids[text[:n]]] * w)
        for n in range(1, len(text) + 1)
        if text[:n] in p.ids
        for rest, w in paths(text[n:], p)
    ]


@pytest.mark.parametrize("word", ["then", "a", "ing  to"])
def test_draws_follow_the_lattice(model, word):
    n = 60_000
    seeds = np.random.default_rng(3).integers(0, 2**63, n).tolist()
    got = Counter(tuple(x.tolist()) for x in pieces.sample([word] * n, seeds, model))
    parts = [w for w in pieces._WORDS.findall(" " + word)]
    want = {(): 1.0}
    for part in parts:
        want = {a + b: v * w for a, v in want.items() for b, w in paths(part, model)}
    total = sum(want.values())
    assert set(got) <= set(want)
    for path, weight in want.items():
        share = weight / total
        assert abs(got[path] / n - share) < 5 * (share / n) ** 0.5 + 1e-4


def test_lossless_and_reproducible(spark, odd, odd_texts, folder, none):
    for df in (odd.select("doc_id", "text"), spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")):
        one = pieces.encode(df, PATH, seed=5)
        ids = sorted((r.doc_id or 0, tuple(r.ids)) for r in one.collect())
        other = pieces.encode(df.repartition(5, "text"), PATH, seed=5)
        assert ids == sorted((r.doc_id or 0, tuple(r.ids)) for r in other.collect())
        back = sorted((r.doc_id or 0, r.text) for r in pieces.decoded(one, PATH).collect())
        assert back == sorted((r.doc_id or 0, r.text or "") for r in df.collect())
        digests = pieces.digests(df, PATH, seed=5).collect()
        assert all(r.lossless for r in digests)
        assert sorted((r.doc_id or 0, r.n_pieces) for r in digests) == sorted((i, len(x)) for i, x in ids)
    changed = sorted((r.doc_id or 0, tuple(r.ids)) for r in pieces.encode(df, PATH, seed=6).collect())
    assert changed != ids
    assert pieces.encode(none, PATH).count() == pieces.digests(none, PATH).count() == 0


def test_the_library_decodes_the_same(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["plain words here", "two  spaces\nand lines", "日本 \U0001f600 é́", " lead"]
    for text, ids in zip(texts, pieces.sample(texts, [1, 2, 3, 4], model), strict=True):
        assert library.decode(ids.tolist()) == text == pieces.decode(ids.tolist(), model)


def test_sharp_weights_give_the_likeliest(model):
    sharp = pieces.Pieces(PATH, 40.0)
    best = max(paths(" then", sharp), key=lambda x: x[1])[0]
    assert pieces.sample(["then"], [1], sharp)[0].tolist() == list(best)


def test_long_word_keeps_its_scale(model):
    (ids,) = pieces.sample(["ab" * 20_000 + "\U0001f600" * 50], [9], model)
    assert pieces.decode(ids.tolist(), model) == "ab" * 20_000 + "\U0001f600" * 50
