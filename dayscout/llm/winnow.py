"""Document fingerprints by winnowing (Schleimer, Wilkerson and Aiken 2003).

The units of a text are its lower-cased words. Every run of ``k`` units has a rolling hash
(cyclic polynomial over the hashes of its units); from each window of ``w`` runs the least
hash is kept, of equal ones the rightmost, with its place. Any two texts that share
w + k - 1 units in a row share a fingerprint, and no match shorter than k units counts.

All of it is Columns over arrays. A hash and its place are one number, the place reversed
in the low bits, so that the least number of a window is the least hash with the rightmost
tie; window minima come from doubling the window, not from looking at all its members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayscout.llm.shared import numbered

K, W = 4, 8
#: low bits of a key that hold the place (counted modulo 2^24), the rest is the hash
_PLACE_BITS = 24
_PLACES = (1 << _PLACE_BITS) - 1


def _rotated(x: Column, n: int) -> Column:
    if n % 64 == 0:
        return x
    return F.shiftleft(x, n % 64).bitwiseOR(F.shiftrightunsigned(x, 64 - n % 64))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W, unit: str = r"\s+") -> DataFrame:
    """``df`` with ``out``: array of keys (hash and place) in the order of the text.

    ``unit`` splits a text into units (a pattern; "" for single characters). A text of
    fewer than k units is one run, one of fewer than w runs one window; null and empty
    texts have no units and an empty array. Equal texts have equal arrays."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), unit, -1)
    words = F.filter(words, lambda x: x != "")
    df = df.withColumn("_h", F.transform(words, lambda x: F.xxhash64(x)))
    n = F.size("_h")

    def run(first: Column, i: Column) -> Column:
        value = _rotated(first, k - 1)
        for j in range(1, k):
            value = value.bitwiseXOR(_rotated(F.get("_h", i + j), k - 1 - j))
        place = F.lit(_PLACES) - i.bitwiseAND(F.lit(_PLACES))
        return value.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(place.cast("long"))

    whole = F.transform(
        F.slice("_h", 1, 1),
        lambda x: F.aggregate("_h", F.lit(0).cast("long"), lambda a, y: F.xxhash64(a, y))
        .bitwiseAND(F.lit(~_PLACES))
        .bitwiseOR(F.lit(_PLACES).cast("long")),
    )
    runs = F.transform(F.slice("_h", F.lit(1), F.greatest(n - (k - 1), F.lit(0))), run)
    df = df.withColumn("_k", F.when(n >= k, runs).otherwise(whole)).drop("_h")
    span, name = 1, "_k"
    while span < w:
        step = min(span, w - span)
        source, name = name, f"_k{span + step}"
        df = df.withColumn(name, _doubled(source, step))
        if source != "_k":
            df = df.drop(source)
        span += step
    short = F.transform(F.slice("_k", 1, 1), lambda x: F.array_min("_k"))
    kept = F.filter(name, lambda x, i: (i == 0) | (x != F.get(name, i - 1)))
    df = df.withColumn(out, F.when(F.size("_k") >= w, kept).otherwise(short))
    return df.drop("_k", name)


def _doubled(source: str, step: int) -> Column:
    """Minima of windows longer by ``step``."""
    part = F.slice(source, F.lit(1), F.greatest(F.size(source) - step, F.lit(0)))
    return F.transform(part, lambda x, i: F.least(x, F.get(source, i + step)))


def places(keys: Column) -> Column:
    """array of (hash, place): place is the number of the unit that the run starts at."""
    return F.transform(
        keys,
        lambda x: F.struct(
            F.shiftrightunsigned(x, _PLACE_BITS).alias("hash"),
            (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).cast("int").alias("place"),
        ),
    )


def hashes(keys: Column) -> Column:
    return F.array_distinct(F.transform(keys, lambda x: F.shiftrightunsigned(x, _PLACE_BITS)))


def spelled(keys: Column) -> Column:
    """The fingerprint as text: hash@place, both in hexadecimal and decimal."""
    return F.array_join(
        F.transform(places(keys), lambda x: F.concat_ws("@", F.lower(F.hex(x["hash"])), x["place"])), " "
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both.cast("double") / either)


def _rows(docs: DataFrame) -> DataFrame:
    """Documents by a key of id and text: rows that repeat both share it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("~"))
    return docs.select("doc_id", text.alias("t"), F.concat_ws(":", name, F.md5(text.cast("binary"))).alias("key"))


def edited_fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many, or all, of the next document's: the one with the next smaller doc_id, after the
    smallest the largest. A null id comes last; of rows that share an id, the order is
    that of the digests of their texts, and rows that repeat id and text are one document
    in this order (each is returned). One document is its own next. Null text counts as
    empty; empty texts have an empty fingerprint, and two of them a likeness of 1.

    Ids and lengths alone are sorted; texts move once to meet their numbers, and the part
    that the previous document needs moves once more."""
    rows = _rows(docs)
    heads = rows.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first(F.length("t")).alias("n"), F.count("*").alias("m")
    )
    ranked, total = numbered(heads, [F.col("doc_id").desc_nulls_last(), F.col("key")], "rank")
    before = ranked.select(
        F.col("key").alias("to"),
        F.col("doc_id").alias("to_id"),
        F.floor(F.col("n") / 2).cast("int").alias("take"),
        F.pmod(F.col("rank") + 1, F.lit(max(total, 1))).alias("rank"),
    )
    lent = ranked.join(before, "rank").select("key", "to", "to_id", "take")
    # both joins read the same columns of the texts, so that one exchange serves them
    texts = rows.select("key", "t")
    sent = texts.join(lent, "key")
    if (ranked.agg(F.max("m")).first()[0] or 1) > 1:
        sent = sent.dropDuplicates(["key"])
    sent = with_fingerprint(sent, "t", "fp", k, w)
    sent = sent.select(F.col("to").alias("key"), F.col("to_id").alias("doc_id"), F.left("t", F.col("take")).alias("head"), hashes(F.col("fp")).alias("next_fp"))
    own = texts.join(sent, "key")
    n = F.length("t")
    edited = F.concat(F.left("t", n - F.floor(n / 2).cast("int")), F.col("head"))
    own = own.select("doc_id", "t", "next_fp", edited.alias("e"))
    own = own.withColumns(
        {"n_chars": F.length("t").cast("long"), "edited_sha256": F.sha2(F.col("e").cast("binary"), 256)}
    )
    own = with_fingerprint(with_fingerprint(own, "t", "fp", k, w), "e", "efp", k, w).drop("t", "e")
    own = own.withColumns({"a": hashes(F.col("fp")), "b": hashes(F.col("efp"))})
    return own.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spelled(F.col("fp")).alias("fingerprint"),
        spelled(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("next_fp")).alias("near_next"),
    )
