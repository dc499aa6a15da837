"""Edges of single operators: runs of white space, hosts of many labels, columns without an
order, ids with several texts."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayscout.llm import exact, hilbert, ngram_join, packing, urls
from dayscout.llm.queries import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("space", [" ", "\n", "\t", "\u3000"])
def test_long_white_space_is_encoded_as_by_the_library(library, space):
    own = packing.ByteBPE(PATH, special=True)
    n = 1_100_000 if space == " " else 120_000
    run = space * n
    for text in (run, run + "x", "a" + run, "a. " + run + " b\n" + run, run + "<|endoftext|>" + run + "'s"):
        assert own.encode(text) == library(text)


def test_mixed_white_space_of_many_lengths(library):
    own, rnd = packing.ByteBPE(PATH, special=True), random.Random(9)
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            parts.append("".join(rnd.choice(" \n\t\r\x0b\x1c\x85\xa0") for _ in range(rnd.choice([1, 3, 999, 1000, 1001, 5000]))))
            parts.append(rnd.choice(["", "a", "'s", "1", "é", "<|endoftext|>", "."]))
        text = "".join(parts)
        assert own.encode(text) == library(text)


def test_white_space_does_not_end_a_packing_job(spark):
    docs = spark.createDataFrame([(1, " " * 5_000_000), (2, "short"), (3, "a" + "\n" * 900_000)], "doc_id long, text string")
    rows = packing.pack(docs, PATH, 1024, 2).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3}
    assert sum(r.length for r in rows if r.doc_id == 1) == 5_000_001


def test_a_host_of_many_labels_costs_little():
    rules = [("com/", True), ("example.com/en/", False), ("a.b.c.d/", False)]
    index = urls.DigestArray(urls.pack(rules))
    host = "x." * 100_000 + "example.com"
    start = time.perf_counter()
    assert urls.judge([host], ["/en/1"], index, "allow") == (["example.com/en/"], ["block"])
    assert time.perf_counter() - start < 0.1
    assert len(urls.probes_of(host, "/en/1", index.path_lengths.tolist(), index.labels.tolist())) == 6
    assert urls.judge(["d", "c.d", "a.b.c.d", ".a.b.c.d", "", "com", "x.com."], ["/"] * 7, index, "none")[1] == [
        "none", "none", "block", "block", "none", "allow", "none"]


def test_rows_with_columns_that_have_no_order(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "A", "y"), (2, "a", "z"), (None, "b", "w")], "doc_id long, text string, v string")
    docs = docs.withColumn("extra", F.create_map(F.lit("k"), "v")).withColumn("many", F.array(F.create_map(F.lit("k"), "v")))
    left = exact.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or 0, r.extra["k"]) for r in left.collect()) == [(0, "w"), (2, "z")]


def test_an_id_with_several_texts_is_one_node(spark):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "u v w x y z")
    rows = [(5, a), (7, a), (7, b), (9, b), (8, c), (6, c), (10, c), (10, "alone in here now and then"), (11, "alone in here now and then"), (3, None), (3, "")]
    groups = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {}
    for r in groups:
        found.setdefault(r.doc_id, set()).add(r.component_id)
    assert found == {5: {5}, 7: {5}, 9: {5}, 8: {6}, 6: {6}, 10: {6}, 11: {6}, 3: {3}}


def test_levels_spread_over_a_dimension_of_few_values():
    values = np.repeat([1.0, 2.0, 3.0, 4.0], 100)
    cuts = np.sort(np.quantile(values, np.arange(1, 32) / 32, method="lower"))
    levels = hilbert.level_of(np.array([1.0, 2.0, 3.0, 4.0, np.nan]), cuts)
    assert levels[4] == 0 and (np.diff(levels[:4]) >= 7).all()


def test_shards_prune_by_every_dimension(spark, folder):
    """Values of a dimension per shard, against shards dealt by a hash."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "source", "text")
    shards = hilbert.document_shards(docs, 16).join(docs.drop("text"), "doc_id")
    by_hash = shards.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(16)))

    def spans(df):
        width = F.percentile("size", 0.9) - F.percentile("size", 0.1)
        per = df.groupBy("shard").agg(F.countDistinct("lang").alias("lang"), F.countDistinct("source").alias("source"), width.alias("size"))
        return per.agg(*[F.avg(c).alias(c) for c in ("lang", "source", "size")]).first()

    own, dealt = spans(shards), spans(by_hash)
    print(own, dealt)
    assert own.lang <= 2.3 < dealt.lang and own.source < 0.6 * dealt.source and own.size < 0.8 * dealt.size


def test_order_and_slots_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = hilbert.document_shards(docs, 4).collect()
    rows = [(r.doc_id, r.hilbert, r.text_crc32) for r in got]
    rows.sort(key=lambda r: (r[1], r[2], r[0]))
    place = {(r.doc_id, r.hilbert, r.text_crc32): (r.shard, r.slot) for r in got}
    bounds = [-(-k * len(rows) // 4) for k in range(5)]
    want = [(k, i - bounds[k]) for k in range(4) for i in range(bounds[k], bounds[k + 1])]
    assert [place[r] for r in rows] == want


def test_documents_are_written_by_shard(spark, odd, tmp_path):
    hilbert.write_documents(odd.drop("shard", "slot"), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and set(odd.columns) - {"shard", "slot"} < set(back.columns)
