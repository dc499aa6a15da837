"""SentencePiece encoding by sampling, and decoding.

A text's segmentations are the paths through the lattice of its pieces. The weight of a
piece is its merge rank plus 2 to the power -alpha: merges are learned by frequency, and
frequency falls with rank. A path's probability is the product of its pieces' weights, normalised.

Forward filtering sums the weights of all paths to each place, and backward sampling
draws the last piece, the one before it, and so on, each in proportion to the weight of
the paths through it: an exact draw. The random numbers are functions of the row's key
and the place in the text, so a row has the same segmentation in any partition and run.

Pieces do not cross the beginning of a run of spaces or a newline, so words are lattices of their
own; equal words of a batch share theirs, and words of equal length are one matrix.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = "▁"
_WORDS = re.compile(r" +[^ \n]*|[^ \n]+|\n")
#: characters of text worked on at a time
BATCH_CHARS = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 18)
#: a symbol from here on is a character spelled in bytes
_SPELLED = 1 << 24
_MODELS: dict = {}


class Pieces:
    """The pieces of a SentencePiece model with byte fallback and identity normalisation."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes: list[bytes] = [b""] * size
        for i in range(size):
            if model.is_byte(i):
                value = int(names[i][3:5], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
        # user-defined pieces carry no rank: they come before the first merge
        rank = {i: -model.get_score(i) if model.get_score(i) > -1e8 else 0.0 for i in plain}
        weights = {i: (max(rank[i], 0.0) + 2.0) ** -alpha for i in plain}
        self.fallback = (size + 2.0) ** -alpha
        self.ids = {}
        for i in plain:
            text = names[i].replace(_SPACE, " ")
            if " " in text.lstrip(" "):
                raise ValueError(f"a piece spans words: {names[i]!r}")
            if "\n" in text and text != "\n":
                raise ValueError(f"a piece spans lines: {names[i]!r}")
            self.bytes[i] = text.encode()
            self.ids[text] = i
        self.longest = max(map(len, self.ids))
        self.weights = weights
        # per length: sorted hashes of the pieces, their ids and weights
        self.tables = {}
        for length in range(1, self.longest + 1):
            texts = [t for t in self.ids if len(t) == length]
            if not texts:
                continue
            h = _hashes(np.array([[ord(c) for c in t] for t in texts], np.uint64).T)
            order = np.argsort(h)
            if len(np.unique(h)) != len(h):
                raise ValueError("two pieces have one hash")
            ids = np.array([self.ids[t] for t in texts], np.int64)[order]
            leading = np.zeros(1 << 18, bool)
            leading[h >> _SHIFT] = True
            self.tables[length] = h[order], ids, np.array([weights[i] for i in ids.tolist()]), leading

    def find(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, weight or 0) of candidates of a length. A table of leading bits tells
        most that are no piece before any search."""
        known, ids, weights, leading = self.tables[length]
        symbol, weight = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes))
        maybe = np.flatnonzero(leading[hashes >> _SHIFT])
        at = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        hit = known[at] == hashes[maybe]
        maybe, at = maybe[hit], at[hit]
        symbol[maybe], weight[maybe] = ids[at], weights[at]
        return symbol, weight


def _hashes(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(codes.shape[1], np.uint64)
    for row in codes:
        h = (h + row + np.uint64(1)) * _BASE
        h ^= h >> np.uint64(29)
    return h


def _uniform(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from the row's seed and a place (splitmix64)."""
    z = seeds + places.astype(np.uint64) * _BASE
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _lattice(words: list[str], p: Pieces):
    """Of words of one length n: for each piece length, (cumulative share, symbol) at every
    end, as matrices of places by words. Shares accumulate over the piece lengths."""
    n = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).T
    codes = np.ascontiguousarray(codes).astype(np.uint64)
    forward = np.zeros((n + 1, len(words)))
    forward[0] = 1.0
    edges = {}
    h = np.zeros_like(codes)
    for length in range(1, min(n, p.longest) + 1):
        h = (h[: n - length + 1] + codes[length - 1 :] + np.uint64(1)) * _BASE
        h ^= h >> np.uint64(29)
        if length not in p.tables:
            continue
        symbol, weight = p.find(length, h.ravel())
        symbol, weight = symbol.reshape(h.shape), weight.reshape(h.shape)
        if length == 1:
            missing = symbol < 0
            symbol = np.where(missing, codes.astype(np.int64) + _SPELLED, symbol)
            weight = np.where(missing, p.fallback, weight)
        if (symbol >= 0).any():
            edges[length] = symbol, weight
    size = forward.shape[1]
    shares = {length: np.empty((n + 1 - length, size)) for length in edges}
    symbols = {length: symbol.astype(np.int32) for length, (symbol, _) in edges.items()}
    for end in range(1, n + 1):
        total = forward[end]
        for length, (_, weight) in edges.items():
            if length <= end:
                total += forward[end - length] * weight[end - length]
                shares[length][end - length] = total
        for length in edges:
            if length <= end:
                shares[length][end - length] /= total
        # no share depends on the scale: keep the rows that are still needed near 1
        if end % 16 == 0:
            forward[max(0, end - p.longest) : end + 1] /= total.copy()
    return {length: (shares[length], symbols[length]) for length in edges}


def _draw(shares, n: int, word: np.ndarray, seeds: np.ndarray, starts: np.ndarray):
    """Backward sampling of occurrences: yields (occurrences, symbols), last pieces first.
    ``starts``: the place of each occurrence in its text."""
    left = np.full(len(word), n)
    who = np.arange(len(word))
    while len(who):
        end, w = left[who], word[who]
        # the largest share is 1 but for rounding: every draw lies below it
        u = _uniform(seeds[who], starts[who] + end) * (1 - 1e-9)
        chosen = np.zeros(len(who), np.int64)
        symbols = np.zeros(len(who), np.int64)
        open_ = np.arange(len(who))
        for length, (share, symbol) in shares.items():
            open_ = open_[end[open_] >= length]
            at, c = end[open_] - length, w[open_]
            take = u[open_] < share[at, c]
            hit = open_[take]
            chosen[hit], symbols[hit] = length, symbol[at[take], c[take]]
            open_ = open_[~take]
            if not len(open_):
                break
        yield who, symbols
        left[who] = end - chosen
        who = who[left[who] > 0]


def sample(texts: list[str], seeds: list[int], p: Pieces) -> list[np.ndarray]:
    """The ids of a sampled segmentation of each text."""
    found = [_WORDS.findall(" " + t) if t else [] for t in texts]
    per_text = np.array([len(w) for w in found], np.int64)
    words = list(itertools.chain.from_iterable(found))
    distinct = list(dict.fromkeys(words))
    index = dict(zip(distinct, range(len(distinct)), strict=True))
    which = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    if not words:
        return [np.empty(0, np.uint32) for _ in texts]
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    size = sizes[which]
    before = np.cumsum(size) - size
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    full = per_text > 0
    start_of_text = np.zeros(len(texts), np.int64)
    start_of_text[full] = before[first[full]]
    starts = before - np.repeat(start_of_text, per_text)
    seed = np.repeat(np.array(seeds, np.uint64), per_text)
    by_size, occurrences = np.argsort(sizes, kind="stable"), np.argsort(size, kind="stable")
    rank = np.empty(len(distinct), np.int64)
    pieces = np.zeros(len(words), np.int64)
    drawn = []
    lengths = np.unique(sizes)
    mine_ends = np.cumsum(np.bincount(np.searchsorted(lengths, sizes)))[:-1]
    own_ends = np.cumsum(np.bincount(np.searchsorted(lengths, size)))[:-1]
    groups = zip(lengths.tolist(), np.split(by_size, mine_ends), np.split(occurrences, own_ends), strict=True)
    for n, mine, own in groups:
        rank[mine] = np.arange(len(mine))
        lattice = _lattice([distinct[i] for i in mine], p)
        for step, (who, symbols) in enumerate(_draw(lattice, n, rank[which[own]], seed[own], starts[own])):
            pieces[own[who]] += 1
            drawn.append((own[who], step, symbols))
    ends = np.cumsum(pieces)
    flat = np.empty(int(ends[-1]), np.int64)
    for occurrence, step, symbols in drawn:
        flat[ends[occurrence] - 1 - step] = symbols
    piece_ends = np.concatenate(([0], ends))[np.cumsum(per_text)]
    return [
        _spelled_out(flat[i:j], p).astype(np.uint32)
        for i, j in zip([0, *piece_ends[:-1].tolist()], piece_ends.tolist(), strict=True)
    ]


def _spelled_out(symbols: np.ndarray, p: Pieces) -> np.ndarray:
    """Symbols of characters without a piece become the ids of their bytes."""
    odd = np.flatnonzero(symbols >= _SPELLED)
    if not len(odd):
        return symbols
    spelled = [p.byte_ids[list(chr(c - _SPELLED).encode())] for c in symbols[odd].tolist()]
    widths = np.ones(len(symbols), np.int64)
    widths[odd] = [len(x) for x in spelled]
    out = np.repeat(symbols, widths)
    at = np.cumsum(widths) - widths
    out[np.concatenate([np.arange(at[i], at[i] + widths[i]) for i in odd])] = np.concatenate(spelled)
    return out


def decode(ids, p: Pieces) -> str:
    """The text of ids; exact for all that ``sample`` returns."""
    return b"".join(map(p.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _model(path: str, alpha: float) -> Pieces:
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = Pieces(path, alpha)
    return _MODELS[path, alpha]


def _encoded(batches: Iterator[pd.DataFrame], p: Pieces, seed: int):
    """(rows, their ids), some characters of text at a time."""
    for b in batches:
        texts = [t or "" for t in b["_text"]]
        seeds = [xxhash.xxh64_intdigest(k or "~", seed) for k in b["_key"]]
        i = 0
        while i < len(texts):
            j, held = i, 0
            while j < len(texts) and (j == i or held + len(texts[j]) <= BATCH_CHARS):
                held += len(texts[j])
                j += 1
            yield b.iloc[i:j], sample(texts[i:j], seeds[i:j], p)
            i = j


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("_id"),
        F.col(id_column).cast("string").alias("_key"),
        F.col(text_column).alias("_text"),
    )


def encode(
    docs: DataFrame,
    model_path: str,
    alpha: float = 1.0,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id and ids, a sampled segmentation of its whole text.

    It depends on the model, alpha, seed, the id and the text, and on nothing else; rows
    that repeat an id and text agree. Null and empty texts have no ids; null ids share a
    key; other columns are ignored; an empty table gives an empty result. Literal U+2581
    and characters without a piece are spelled in bytes. A word takes about 200 bytes of
    memory a character; all else is worked on in batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, ids in _encoded(batches, _model(model_path, alpha), seed):
            yield pd.DataFrame({"_id": rows["_id"], "ids": pd.Series([x.astype(np.int32) for x in ids], rows.index)})

    kind = docs.schema[id_column].dataType.simpleString()
    keyed = _keyed(docs, id_column, text_column)
    return keyed.mapInPandas(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_column)


def decoded(rows: DataFrame, model_path: str, ids_column: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of their ids; null ids give an empty text."""
    names = [c for c in rows.columns if c != out]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = _model(model_path, 1.0)
        for b in batches:
            texts = [decode(x, p) if x is not None else "" for x in b[ids_column]]
            yield b[names].assign(**{out: pd.Series(texts, b.index, object)})

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInPandas(run, f"{schema}, `{out}` string")


def digests(
    docs: DataFrame,
    model_path: str,
    alpha: float = 1.0,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``encode`` and ``decoded`` in one pass: id, n_pieces, ids_crc32 (little-endian 32-bit
    ids), decoded_crc32 (UTF-8), lossless. Edge cases as in ``encode``."""
    import zlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = _model(model_path, alpha)
        for rows, ids in _encoded(batches, p, seed):
            back = [b"".join(map(p.bytes.__getitem__, x.tolist()))[1:] for x in ids]
            yield pd.DataFrame(
                {
                    "_id": rows["_id"],
                    "n_pieces": [len(x) for x in ids],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    "decoded_crc32": [zlib.crc32(x) for x in back],
                    "lossless": [x == (t or "").encode() for x, t in zip(back, rows["_text"], strict=True)],
                }
            )

    kind = docs.schema[id_column].dataType.simpleString()
    fields = f"_id {kind}, n_pieces long, ids_crc32 long, decoded_crc32 long, lossless boolean"
    return _keyed(docs, id_column, text_column).mapInPandas(run, fields).withColumnRenamed("_id", id_column)
