import zlib

import numpy as np
import pytest

from dayscout.llm import hilbert


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_point_once_in_steps_of_one(n, bits):
    side = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(side)] * n), -1).reshape(-1, n)
    index = hilbert.hilbert_index(points, bits)
    assert sorted(index.tolist()) == list(range(side**n))
    walk = points[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_law_of_rows(spark, odd, odd_texts):
    got = hilbert.document_shards(odd, 4).collect()
    assert len(got) == len(odd_texts)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = sorted((i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_texts)
    assert want == sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in order] == sorted(r.hilbert for r in got)


def test_fewer_rows_than_shards_and_none(spark, odd, none):
    few = odd.where("doc_id in (4, 9)")
    assert len({r.shard for r in hilbert.document_shards(few, 16).collect()}) == 2
    assert hilbert.document_shards(none).count() == 0


def test_files_prune(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    shards = hilbert.document_shards(docs, 8)
    spans = shards.groupBy("shard").agg({"size": "max", "slot": "count"}).collect()
    whole = max(r["max(size)"] for r in spans)
    assert min(r["max(size)"] for r in spans) < whole / 4
    hilbert.write_shards(shards, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 8
