"""Best-fit packing planned over the histogram of lengths.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. Only the
counts per length, ``capacity`` numbers at most, reach the driver. There, best fit
decreasing runs over counts: all pieces of one length are placed at once, into the
fullest sequences that still hold them, so the plan is a short list of runs whatever the
number of documents. A run says: the pieces ranked a to b within length l go to the
sequences from s on, q in each, from offset o. Pieces then take their planned slots by
their rank within the length.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.llm.shared import numbered, stored

#: tokenizers loaded by this worker, by path
_STATE: dict = {}


class ByteBPE:
    """The ids of a byte-level BPE tokenizer file as little-endian 32-bit bytes.

    ``path`` is a tokenizers JSON file (vocabulary and merges). Ids are those of the
    tokenizers library with ``add_special_tokens=False``: as in its default settings, the
    name of a special token in a text is that token. With ``special=False``, as with the
    library's ``encode_special_tokens``, such a name is ordinary text. The same vocabulary
    runs in tiktoken, four times as fast.

    Its pattern looks ahead from the end of white space, which no run of a million
    characters survives. Long runs are therefore cut out before: all of a run but its last
    character, or all of it at the end of the text, is one piece, as by the pattern."""

    def __init__(self, path: str, special: bool = False):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        names = {t["content"]: t["id"] for t in model.get("added_tokens", ()) if t.get("special")}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in model["model"]["vocab"].items()
            if token not in names
        }
        self._encoding = tiktoken.Encoding(
            "file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=names
        )
        self._special = names if special else {}
        longest_first = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._names = re.compile(f"({'|'.join(longest_first)})") if longest_first else None

    def encode(self, text: str) -> bytes:
        parts = self._names.split(text) if self._names else [text]
        return b"".join(
            np.array([self._special[p]], "<u4").tobytes() if i % 2 else self._between(p)
            for i, p in enumerate(parts)
        )

    def _between(self, text: str) -> bytes:
        """Ids of a text without special names."""
        out, start = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += [self._plain(text[start : run.start()]), self._piece(text[run.start() : end])]
            start = end
        return b"".join([*out, self._plain(text[start:])])

    def _plain(self, text: str) -> bytes:
        return np.array(self._encoding.encode_ordinary(text), "<u4").tobytes()

    def _piece(self, text: str) -> bytes:
        return np.array(self._encoding._encode_single_piece(text.encode()), "<u4").tobytes()

    def pieces(self, pre_token: str) -> int:
        """How many ids one pre-token has."""
        return len(self._piece(pre_token)) // 4


#: the split of this family of tokenizers, a fixed value of the format
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: what the pattern calls white space; Python's own class has four control characters more
_LONG_SPACE = re.compile(r"[^\S\x1c-\x1f]{1000,}")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such a vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _tokeniser(path: str) -> ByteBPE:
    if path not in _STATE:
        _STATE[path] = ByteBPE(path, special=True)
    return _STATE[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of ``capacity``, the first maybe
    shorter."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(s, first if s == 0 else capacity) for s in starts]


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokeniser = _tokeniser(path)
        tail = int(end_id).to_bytes(4, "little")
        for b in batches:
            out = []
            for key, text in zip(b["_id"], b["_text"], strict=True):
                raw = tokeniser.encode(text or "") + tail
                for piece, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                    out.append((key, piece, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])))
            yield pd.DataFrame(out, columns=["_id", "piece", "start", "length", "ids_crc32"])

    return run


def plan(histogram: dict[int, int], capacity: int) -> tuple[pd.DataFrame, int]:
    """(runs, number of sequences) of best fit decreasing over {length: count}.

    A run: pieces of ``length`` with rank in [low, high) go to sequences first, first + 1,
    ..., ``each`` in a row per sequence, the first of them at ``offset``."""
    open_: dict[int, list[list[int]]] = defaultdict(list)  # room left: [first, count] runs
    runs, made = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def place(first: int, count: int, room: int, length: int = length) -> None:
            nonlocal left, rank
            each = room // length
            full = min(count, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                if room - each * length:
                    open_[room - each * length].append([first, full])
            if full < count and left:  # the last sequence takes fewer
                runs.append((length, rank, rank + left, first + full, left, capacity - room))
                if room - left * length:
                    open_[room - left * length].append([first + full, 1])
                rank, left, full = rank + left, 0, full + 1
            if full < count:
                open_[room].append([first + full, count - full])

        for room in sorted(r for r in open_ if r >= length):
            if not left:
                break
            for first, count in open_.pop(room):
                if left:
                    place(first, count, room)
                else:
                    open_[room].append([first, count])
        if left:
            count = -(-left // (capacity // length))
            first, made = made, made + count
            place(first, count, capacity)
    return pd.DataFrame(runs, columns=["length", "low", "high", "first", "each", "offset"]), made


def _seated(runs: pd.DataFrame, starts: dict[int, int]):
    """Pieces, ranked over all lengths, to their sequence and offset."""
    low = runs["low"].to_numpy(np.int64) + runs["length"].map(starts).to_numpy(np.int64)
    order = np.argsort(low)
    low = low[order]
    first, each, offset = (runs[c].to_numpy(np.int64)[order] for c in ("first", "each", "offset"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rank = b["_rank"].to_numpy(np.int64)
            j = np.searchsorted(low, rank, "right") - 1
            k = rank - low[j]
            b["sequence_id"] = first[j] + k // each[j]
            b["offset"] = offset[j] + k % each[j] * b["length"].to_numpy(np.int64)
            yield b.drop(columns=["_rank"])

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; null and empty texts are that one token.
    Longer ones are cut into pieces of ``capacity``, the first maybe shorter. Rows that
    repeat an id are packed one by one, a null id stays null, other columns are ignored,
    and an empty table gives an empty result. The driver holds a count per length and the
    runs of the plan; a piece's rank comes from a global sort by length, in which the full
    pieces, often a third of all, span as many tasks as they need."""
    kind = docs.schema[id_column].dataType.simpleString()
    fields = f"_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = stored(
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInPandas(
            _pieces(tokenizer_path, end_id, capacity), fields
        ),
        "pieces",
    )
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    starts, before = {}, 0
    for length in sorted(counts, reverse=True):
        starts[length], before = before, before + counts[length]
    spread = F.xxhash64("_id", "piece", "ids_crc32")
    ranked, _ = numbered(pieces, [F.desc("length"), spread, F.col("_id"), F.col("piece")], "_rank")
    if not before:
        return pieces.select(
            F.col("_id").alias(id_column), "piece", "start", "length", "ids_crc32",
            F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        )
    seated = ranked.mapInPandas(_seated(runs, starts), f"{fields}, sequence_id long, offset long")
    return seated.withColumnRenamed("_id", id_column)
