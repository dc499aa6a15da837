import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from dayscout.llm import packing
from dayscout.llm.queries import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [np.array(e.ids, "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_those_of_the_library(spark, odd_texts, folder, library):
    rnd = random.Random(5)
    texts = [t or "" for _, t in odd_texts] + ["<|endoftext|> x", "'s 't　 1½ ١٢\r\n\u0085 é́"]
    texts += ["".join(rnd.choice("ab 1!\n\t é'sé.  ") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    own = packing.ByteBPE(PATH)
    assert all(own.encode(t) == ids.tobytes() for t, ids in zip(texts, library(texts), strict=True))


def check(rows, ids_of, capacity):
    seats = {}
    pieces = {}
    for r in rows:
        seats.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for s in seats.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, own in pieces.items():
        ids = ids_of[doc]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids)
        assert all(r.length == capacity for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].astype("<u4").tobytes())
    return len(seats)


def test_pieces_and_places(odd, odd_texts, library, none):
    unique = [(i, t) for i, t in odd_texts if i not in (None, 7)]
    df = odd.where("doc_id is not null and doc_id <> 7")
    ids_of = {i: np.append(library([t or ""])[0], 2) for i, t in unique}
    for capacity in (1024, 16):
        check(packing.pack(df, PATH, capacity).collect(), ids_of, capacity)
    assert packing.pack(odd, PATH).select("doc_id").distinct().count() == len({i for i, _ in odd_texts})
    assert packing.pack(none, PATH).count() == 0


def best_fit_decreasing(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in room if r >= n), default=None)
        if fit is not None:
            room.remove(fit)
        room.append((fit if fit is not None else capacity) - n)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_piece_by_piece(seed):
    rnd = random.Random(seed)
    lengths = [min(50, 1 + int(rnd.expovariate(1 / 14))) for _ in range(700)]
    histogram = dict(Counter(lengths))
    runs, made = packing.plan(histogram, 50)
    assert made == best_fit_decreasing(lengths, 50)
    placed = Counter()
    rooms = Counter()
    for r in runs.itertuples():
        placed[r.length] += r.high - r.low
        for k in range(r.high - r.low):
            rooms[r.first + k // r.each] += r.length
    assert placed == histogram and max(rooms.values()) <= 50 and len(rooms) == made


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
