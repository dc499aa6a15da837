"""Shards in Hilbert-curve order of several metadata dimensions.

Every dimension is quantised to 2^bits levels by the quantiles of the whole table; the
levels are the coordinates of a point, and the point's index on the Hilbert curve orders
the rows. Runs of that order are files in which every dimension spans a narrow range, so
that minima and maxima prune files whichever dimension a reader filters by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from dayscout.llm.shared import numbered


def hilbert_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Places on the curve of points (rows) with ``bits`` bits in each of n dimensions
    (Skilling 2004: undo the rotations, Gray-code, and interleave)."""
    x = coordinates.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > one:
        p = q - one
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    q = np.uint64(1 << (bits - 1))
    while q > one:
        turn ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= turn
    out = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.astype(np.int64)


def ordered_code(value: Column, low: str, high: str) -> Column:
    """A double that orders strings between ``low`` and ``high`` by the six bytes after
    their common beginning."""
    a, b = low.encode(), high.encode()
    same = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
    tail = F.substring(value.cast("binary"), same + 1, 6)
    return F.conv(F.rpad(F.hex(tail), 12, "0"), 16, 10).cast("double")


def quantiles(df: DataFrame, dimensions: Sequence[str], bits: int) -> tuple[list[Column], list[np.ndarray]]:
    """Per dimension a double that orders its values, and the cuts between levels: 2^bits
    - 1 approximate quantiles over all rows, so they stay this few at any size."""
    kinds = {c: df.schema[c].dataType for c in dimensions}
    texts = [c for c in dimensions if not isinstance(kinds[c], NumericType)]
    codes = {c: F.col(f"`{c}`").cast("double") for c in dimensions if c not in texts}
    if texts:
        ends = [
            f(F.col(f"`{c}`").cast("string")).alias(f"{k}{i}")
            for i, c in enumerate(texts)
            for k, f in (("low", F.min), ("high", F.max))
        ]
        found = df.agg(*ends).first()
        for i, c in enumerate(texts):
            low, high = found[f"low{i}"] or "", found[f"high{i}"] or ""
            codes[c] = ordered_code(F.col(f"`{c}`").cast("string"), low, high)
    levels = 1 << bits
    shares = [k / levels for k in range(1, levels)]
    cuts = df.agg(
        *[F.percentile_approx(codes[c], shares, 100 * levels).alias(str(i)) for i, c in enumerate(dimensions)]
    ).first()
    # a frequent value is several cuts, all of which stay: values are then as far apart on
    # the curve as rows of other values lie between them
    bounds = [np.sort([x for x in cuts[i] or [] if x is not None]) for i in range(len(dimensions))]
    return [codes[c] for c in dimensions], bounds


def level_of(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The level of each value, in the middle of the cuts that equal it; a missing one is
    the lowest."""
    if not len(cuts):
        return np.zeros(len(values), np.int64)
    middle = (np.searchsorted(cuts, values, "left") + np.searchsorted(cuts, values, "right")) // 2
    return np.where(np.isnan(values), 0, middle)


def hilbert_shards(
    df: DataFrame,
    shards: int,
    dimensions: Sequence[str],
    unique: Sequence[str],
    bits: int = 5,
) -> DataFrame:
    """``df`` with hilbert (place on the curve), shard (0 to shards - 1) and slot (from 0,
    gapless within a shard). The rows are cut into runs that differ by one row at most.

    ``unique`` columns order rows of one place on the curve: a third of all rows may share
    one and are still dealt to many tasks. Rows that agree in these too may take each
    other's slot. A null dimension is the lowest level; an empty table gives an empty
    result; a column named as an output is replaced."""
    if len(dimensions) * bits > 62:
        raise ValueError("too many bits for a 64-bit index")
    names = [f"_code{i}" for i in range(len(dimensions))]
    rows = df.drop("hilbert", "shard", "slot")
    codes, bounds = quantiles(rows, dimensions, bits)
    coded = rows.withColumns(dict(zip(names, codes, strict=True)))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            levels = [level_of(b[n].to_numpy(float), cuts) for n, cuts in zip(names, bounds, strict=True)]
            b["hilbert"] = hilbert_index(np.stack(levels, 1), bits)
            yield b.drop(columns=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = coded.mapInPandas(index, f"{schema}, hilbert long")
    keys = [F.col("hilbert"), *[F.col(f"`{c}`") for c in unique]]
    ranked, total = numbered(placed, keys, "_rank")
    if not total:
        return ranked.withColumn("shard", F.lit(0)).withColumn("slot", F.col("_rank")).drop("_rank")
    shard = F.expr(f"cast(_rank * {shards} div {total} as int)")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - first).drop("_rank")


def document_shards(docs: DataFrame, shards: int = 16, bits: int = 5) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes and one for the end; null text is
    empty), text_crc32, law, shard, slot, grown_shard, hilbert.

    The dimensions are language, source and size; rows of one place on the curve lie in
    order of the text's CRC, so that equal texts are neighbours. Law ``rows``: shards differ
    by one row at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    sharded = hilbert_shards(rows, shards, ["source", "lang", "size"], ["text_crc32", "doc_id"], bits)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def write_documents(docs: DataFrame, path: str, shards: int = 16, bits: int = 5) -> None:
    """Write the documents themselves, with all their columns, as ``write_shards`` does."""
    size = (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1).alias("_size")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_crc")
    placed = hilbert_shards(docs.select("*", size, crc), shards, ["source", "lang", "_size"], ["_crc", "doc_id"], bits)
    write_shards(placed.drop("_size", "_crc", "hilbert"), path)


def write_shards(df: DataFrame, path: str) -> None:
    """Write the output of ``hilbert_shards`` as one folder per shard, each in the order of
    its slots; a range of slots is one task's work, however large a shard is."""
    (
        df.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
