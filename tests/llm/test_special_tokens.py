"""Names of special tokens in texts, against the library at its default settings."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from dayscout.llm import packing
from dayscout.llm.queries import tokenizer_path

PATH = tokenizer_path()
END = "<|endoftext|>"
TEXTS = [
    f"a{END}b", END, f"{END}{END} x", f" {END} \n{END}\t", f"<|endoftext|{END}|>", "<|endoftext|", "a b  c",
    f"don't{END}'s  {END}  é́日本", f"x {END}" * 700, "",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return [np.array([*e.ids, 2], "<u4") for e in t.encode_batch(TEXTS, add_special_tokens=False)]


def test_ids_of_special_names(library):
    own = packing.ByteBPE(PATH, special=True)
    assert [own.encode(t) for t in TEXTS] == [ids[:-1].tobytes() for ids in library]
    assert own.encode(TEXTS[0]) == np.array([64, 50256, 65], "<u4").tobytes()


def test_packed_pieces_hold_the_special_tokens(spark, library):
    rows = packing.pack(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), PATH, 16).collect()
    assert {r.doc_id for r in rows} == set(range(len(TEXTS)))
    for doc, ids in enumerate(library):
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
