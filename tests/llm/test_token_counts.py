import random
import sys
import uuid

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayscout.llm import queries, token_counts
from dayscout.llm.queries import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def split(library, text):
    return [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def parts(text):
    """Pre-tokens by way of words."""
    first, *rest = token_counts._WORD_START.split(text)
    chunk = token_counts.Chunk(PATH)
    return sum(map(chunk.tokens, ([first] if first else []) + [" " + w for w in rest]), [])


def test_words_hold_whole_pre_tokens_at_every_code_point(library):
    for low in range(0, sys.maxunicode, 256):
        points = [chr(c) for c in range(low, low + 256) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c} {c}b" for c in points)
        if low < 0x600:
            text += "".join(f"{c}{d}1 {c}" for c in points for d in "a1'. \t")
        assert parts(text) == split(library, text)


def test_words_hold_whole_pre_tokens_of_mixed_texts(library):
    rnd = random.Random(3)
    for _ in range(5000):
        text = "".join(rnd.choice("ab 1!\n\t é'sé.   ") for _ in range(rnd.randint(0, 40)))
        assert parts(text) == split(library, text)


def check(rows, texts, library, limit=1024):
    want = sorted(
        (str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > limit)
        for i, t in texts
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want


def test_query_equals_the_library(spark, folder, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(queries.op13_token_counts(spark, folder).collect(), texts, library)


@pytest.mark.parametrize("chunk_chars", [1, 500, 4_000_000])
def test_odd_rows_whatever_the_chunks(spark, odd, odd_texts, library, chunk_chars):
    check(token_counts.token_counts(odd, PATH, chunk_chars=chunk_chars).collect(), odd_texts, library)


def test_special_names_and_long_runs(spark, library):
    texts = [
        (1, "<|endoftext|>"), (2, "a<|endoftext|>b <|endoftext|>  <|endoftext|><|endoftext|>c"), (3, "<|endoftext"),
        (4, " " * 1_100_000 + "x"), (5, "\n" * 900_000), (6, "a" + "\t" * 300_000 + " b"), (7, "ab" * 100_000),
    ]
    rows = token_counts.token_counts(spark.createDataFrame(texts, "doc_id long, text string"), PATH).collect()
    check(rows, texts, library)


def test_a_pre_token_is_counted_once(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40)], "doc_id long, text string")
    real = token_counts._piece_counts

    def spy(path):
        run = real(path)

        def counted(batches):
            def seen_by(counter=token_counts.ByteBPE.pieces):
                def pieces(self, token):
                    with open(f"{tmp_path}/{uuid.uuid4().hex}", "w") as f:
                        f.write(token)
                    return counter(self, token)

                return pieces

            real_pieces = token_counts.ByteBPE.pieces
            token_counts.ByteBPE.pieces = seen_by()
            try:
                yield from run(batches)
            finally:
                token_counts.ByteBPE.pieces = real_pieces

        return counted

    monkeypatch.setattr(token_counts, "_piece_counts", spy)
    rows = token_counts.token_counts(docs.repartition(8), PATH, chunk_chars=20).collect()
    seen = sorted(f.read_text() for f in tmp_path.iterdir())
    assert {r.n_tokens for r in rows} == {3} and seen == [" here", " words", "same"]


def test_empty_table(spark, none):
    out = token_counts.token_counts(none, PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


def test_other_id_kinds(spark, library):
    texts = [("x", "some text"), (None, "other"), ("x", "some text")]
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    check(token_counts.token_counts(docs, PATH).select("*", F.lit(1).alias("z")).collect(), texts, library)
