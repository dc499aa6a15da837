"""Token counts without token ids.

A byte-level BPE cuts a text into pre-tokens and then each pre-token into pieces on its
own, so the number of pieces of a pre-token is the same wherever it stands. Tasks count
the pre-tokens of each document and store the counts beside the distinct pre-tokens of a
chunk of documents. The vocabularies of all chunks meet in one sorted exchange, where the
pieces of each pre-token are counted once, and every chunk gets the counts of its own
pre-tokens back in a join with its documents. A document's tokens are then a sum of
products.

A pre-token travels once per chunk that holds it, not once per document, and never as
ids. What a document stores is one place in the chunk's vocabulary and one count per
distinct pre-token.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayscout.llm.packing import _PATTERN, ByteBPE
from dayscout.llm.shared import stored

#: a space between two characters that are not white space starts a pre-token, whatever
#: stands farther left or right
_WORD_START = re.compile(r"(?<=\S) (?=\S)")

#: below this character the classes of all Unicode versions in use are the same
_SETTLED = "\u0530"
_PRE_TOKEN = regex.compile(_PATTERN)

#: what this worker has loaded, by path
_STATE: dict = {}


def _pre_tokenizer(path: str):
    """(pre-tokenizer of the library, pattern that finds special names or None)."""
    if path not in _STATE:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        names = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.special]
        names.sort(key=len, reverse=True)
        pattern = re.compile("|".join(map(re.escape, names))) if names else None
        _STATE[path] = tokenizer.pre_tokenizer, pattern
    return _STATE[path]


def _counter(path: str) -> ByteBPE:
    if ("ids", path) not in _STATE:
        _STATE["ids", path] = ByteBPE(path)
    return _STATE["ids", path]


class _Codes(dict):
    """Numbers from 0 for keys in the order they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = code = len(self)
        return code


class Chunk:
    """Pre-token counts of a bounded number of texts, over one vocabulary."""

    def __init__(self, path: str):
        self._cut, self._special = _pre_tokenizer(path)
        self._first, self._later = _Codes(), _Codes()  # words at the start, after a space
        self._codes, self._times = (array("q"), array("q")), (array("q"), array("q"))
        self._ends: tuple[list[int], list[int]] = ([], [])
        self.chars = 0

    def add(self, text: str) -> int:
        """Count the words of a text; the number of its special names is returned."""
        parts = [text]
        if self._special and self._special.search(text):
            parts = self._special.split(text)
        words: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for part in parts:
            first, *rest = _WORD_START.split(part)
            if first:
                words[0][first] += 1
            words[1].update(rest)
        for k, known in enumerate((self._first, self._later)):
            self._codes[k].extend(map(known.__getitem__, words[k]))
            self._times[k].extend(words[k].values())
            self._ends[k].append(len(self._codes[k]))
        self.chars += len(text)
        return len(parts) - 1

    def tokens(self, word: str) -> list[str]:
        """The pre-tokens of a word, as the library cuts them."""
        if max(word) < _SETTLED:  # characters that no later Unicode version has changed
            return [word] if word[1:].isalpha() and word[0] == " " else _PRE_TOKEN.findall(word)
        return [word[a:b] for _, (a, b) in self._cut.pre_tokenize_str(word)]

    def counted(self, block: int = 256) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
        """(vocabulary, (places, frequencies) of each text), made for a block of texts at a
        time."""
        places = _Codes()
        of_word, ends = array("q"), array("q", [0])  # places of the pre-tokens of all words
        for words, space in ((self._first, ""), (self._later, " ")):
            for word in words:
                of_word.extend(map(places.__getitem__, self.tokens(space + word)))
                ends.append(len(of_word))
        at, starts = np.frombuffer(of_word, np.int64), np.frombuffer(ends, np.int64)
        texts, out = len(self._ends[0]), []
        for low in range(0, texts, block):
            high = min(low + block, texts)
            parts = [
                self._expanded(k, shift, low, high, at, starts)
                for k, shift in ((0, 0), (1, len(self._first)))
            ]
            token, times, text = (np.concatenate(p) for p in zip(*parts, strict=True))
            keys, where = np.unique(text * len(places) + token, return_inverse=True)
            sums = np.bincount(where, times, len(keys)).astype(np.int64)
            cuts = np.searchsorted(keys, np.arange(1, high - low) * len(places))
            keys %= max(1, len(places))
            out += zip(np.split(keys, cuts), np.split(sums, cuts), strict=True)
        return list(places), out

    def _expanded(self, k: int, shift: int, low: int, high: int, at: np.ndarray, starts: np.ndarray):
        """(place, frequency, text from 0) of the pre-tokens of the words of some texts."""
        first = self._ends[k][low - 1] if low else 0
        ends = np.array(self._ends[k][low:high], np.int64)
        word = np.frombuffer(self._codes[k], np.int64)[first : ends[-1]] + shift
        lengths = starts[word + 1] - starts[word]
        before = np.cumsum(lengths) - lengths
        token = at[np.repeat(starts[word] - before, lengths) + np.arange(lengths.sum())]
        of_text = np.repeat(np.arange(high - low), np.diff(ends, prepend=first))
        times = np.frombuffer(self._times[k], np.int64)[first : ends[-1]]
        return token, np.repeat(times, lengths), np.repeat(of_text, lengths)


def _packed(values: np.ndarray) -> bytes:
    """Numbers by planes of bytes, as many as the largest needs: the higher planes, nearly
    all zeros, cost little once compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    width = next((w for w in range(8, 0, -1) if planes[w - 1].any()), 1)
    return bytes([width]) + planes[:width].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1).astype(np.int64)
    return (planes << (8 * np.arange(raw[0]))[:, None]).sum(axis=0)


_FIELDS = "chunk long, _bytes long, _special long, places binary, times binary, vocabulary array<string>"


def _frequencies(path: str, chunk_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        chunk_id = TaskContext.get().partitionId() << 32
        chunk, rows = Chunk(path), []
        for batch in batches:
            for key, text in zip(batch["_id"], batch["_text"], strict=True):
                text = text or ""
                rows.append((key, len(text.encode()), chunk.add(text)))
                if chunk.chars >= chunk_chars:
                    yield _chunk_rows(rows, chunk, chunk_id)
                    chunk, rows = Chunk(path), []
                    chunk_id += 1
        if rows:
            yield _chunk_rows(rows, chunk, chunk_id)

    return run


def _chunk_rows(rows: list[tuple], chunk: Chunk, chunk_id: int) -> pd.DataFrame:
    vocabulary, counts = chunk.counted()
    out = [
        (*row, _packed(np.diff(places, prepend=0)), _packed(times), None)
        for row, (places, times) in zip(rows, counts, strict=True)
    ]
    out.append((None, None, None, None, None, vocabulary))
    out = pd.DataFrame(out, columns=["_id", "_bytes", "_special", "places", "times", "vocabulary"], dtype=object)
    return out.assign(chunk=chunk_id)


def _piece_counts(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(path)
        token, pieces = None, 0  # rows are sorted: equal pre-tokens follow each other
        for b in batches:
            out = []
            for t in b["token"]:
                if t != token:
                    token, pieces = t, counter.pieces(t)
                out.append(pieces)
            yield pd.DataFrame({"of": b["chunk"], "place": b["place"], "pieces": out})

    return run


def _sums(limit: int):
    def run(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        pieces = np.zeros(len(counts), np.int64)
        pieces[counts["place"].to_numpy(np.int64)] = counts["pieces"].to_numpy(np.int64)
        tokens = [
            int(pieces[np.cumsum(_unpacked(p))] @ _unpacked(t))
            for p, t in zip(docs["places"], docs["times"], strict=True)
        ]
        out = docs[["_id", "_bytes"]].rename(columns={"_bytes": "n_bytes"})
        out["n_tokens"] = docs["_special"].to_numpy(np.int64) + np.array(tokens, np.int64)
        out["over_limit"] = out["n_tokens"] > limit
        return out

    return run


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_chars: int = 32_000_000,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the tokenizers library for the byte-level BPE file at
    ``tokenizer_path``, with ``add_special_tokens=False``; a special token's name inside a
    text is that token, the library's default. Null and empty texts have no bytes and no
    tokens. Rows that repeat an id are counted one by one, a null id stays null, other
    columns are ignored, an empty table gives an empty result, and a text of any length
    is counted whole, runs of white space and words without end included.

    A chunk holds documents of ``chunk_chars`` characters, or one longer document, so what
    a task keeps is bounded by it. A pre-token that every chunk holds has one row per
    chunk: a small part of the rows, even where it is half of all words."""
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    held = stored(
        texts.mapInPandas(_frequencies(tokenizer_path, chunk_chars), f"_id {kind}, {_FIELDS}"),
        "pre_tokens",
    )
    counted = (
        held.where("vocabulary IS NOT NULL")
        .select("chunk", F.posexplode("vocabulary").alias("place", "token"))
        .repartition("token")
        .sortWithinPartitions("token")
        .mapInPandas(_piece_counts(tokenizer_path), "of long, place int, pieces int")
    )
    rows = held.where("vocabulary IS NULL").drop("vocabulary")
    return (
        rows.groupBy("chunk")
        .cogroup(counted.groupBy("of"))
        .applyInPandas(_sums(limit), f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
        .withColumnRenamed("_id", id_column)
    )
