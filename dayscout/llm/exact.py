"""Exact duplicates by deterministic block naming.

Texts are cut into fixed-size blocks. Sorting all blocks brings equal ones together, and
each gets one integer name; then adjacent pairs of names are named in turn, so that a
text of n blocks has one name after ceil(log2 n) rounds. Two texts have the same
(number of blocks, name) if and only if they are equal: names come from comparing
contents, never from digests, so there is nothing to collide. (After Karp, Miller and
Rosenberg 1972.)

Each chunk of documents first numbers its own distinct blocks, so a block that a third of
all rows share meets the sort once per chunk and not once per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayscout.llm.shared import stored

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LOCAL = "kind string, key long, block binary, _id {id}, blocks array<long>, sha string"
_COLUMNS = ["kind", "key", "block", "_id", "blocks", "sha"]
#: a chunk is cut when its distinct blocks reach so many bytes, or at so many rows
CHUNK_BYTES, CHUNK_ROWS = 32 << 20, 100_000


def normalised(text: str | None) -> bytes:
    """The UTF-8 bytes with A-Z lower-cased; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


def _chunked(block_bytes: int, chunk_bytes: int, chunk_rows: int):
    """Rows of kind b (a distinct block of the chunk) and d (a document as the keys of
    its blocks). Keys hold partition, chunk and number: 20, 19 and 24 bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 43
        names: dict[bytes, int] = {}
        docs: list[tuple] = []
        held = 0

        def flush() -> Iterator[pd.DataFrame]:
            blocks = [("b", key, b, None, None, None) for b, key in names.items()]
            step = max(1, (4 << 20) // block_bytes)
            for rows in (blocks[i : i + step] for i in range(0, len(blocks), step)):
                yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
            for i in range(0, len(docs), 4096):
                yield pd.DataFrame(docs[i : i + 4096], columns=_COLUMNS, dtype=object)

        for batch in batches:
            for key, text in zip(batch["_id"], batch["_text"], strict=True):
                raw = normalised(text)
                mine = []
                for i in range(0, max(1, len(raw)), block_bytes):
                    piece = raw[i : i + block_bytes]
                    if piece not in names:
                        names[piece] = base + len(names)
                        held += len(piece)
                    mine.append(names[piece])
                sha = hashlib.sha256(raw).hexdigest()
                docs.append(("d", base + len(docs), None, None if pd.isna(key) else key, mine, sha))
                if held >= chunk_bytes or len(docs) >= chunk_rows:
                    yield from flush()
                    names, docs, held, base = {}, [], 0, base + (1 << 24)
        if docs:
            yield from flush()

    return run


def identities(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = 4096,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(row, _id, sha, n, name): one row per row of ``docs``, ``row`` a unique number and
    (n, name) the identity of its text."""
    kind = docs.schema[id_column].dataType.simpleString()
    local = stored(
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInPandas(
            _chunked(block_bytes, chunk_bytes, chunk_rows), _LOCAL.format(id=kind)
        ),
        "blocks",
    )
    # the sort: equal blocks side by side, all named after the least number among them
    names = local.where("kind = 'b'").select(
        F.col("key").alias("block_key"), F.min("key").over(Window.partitionBy("block")).alias("name")
    )
    rows = local.where("kind = 'd'").select(F.col("key").alias("row"), "_id", "sha", "blocks")
    spelled = stored(
        rows.select("row", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block_key"))
        .join(names, "block_key")
        .select("row", "n", "pos", "name"),
        "spelled",
    )
    done = spelled.where("n = 1").select("row", "n", "name")
    longest = spelled.agg(F.max("n")).first()[0] or 1
    level = spelled.where("n > 1")
    for _ in range((longest - 1).bit_length()):
        even = F.col("pos") % 2 == 0
        pairs = level.groupBy("row", "n", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("r"),
        )
        pairs = stored(pairs, "pairs")
        named = stored(
            pairs.select("l", "r")
            .distinct()
            .sortWithinPartitions("l", "r")
            .withColumn("name", F.monotonically_increasing_id()),
            "pair_names",
        )
        level = stored(pairs.join(named, ["l", "r"]).select("row", "n", "pos", "name"), "spelled")
    # by now a text of several blocks is one name at place 0
    done = done.unionByName(level.select("row", "n", "name"))
    return rows.drop("blocks").join(done, "row")


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = 4096
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id (id of the row that stays), group_size,
    kept, text_sha256 of the normalised text (A-Z lower-cased, UTF-8).

    Of equal texts the row with the largest id stays; a null id loses against any other,
    and of rows that share the largest id one stays. Null text counts as empty, and empty
    texts are equal to each other. Other columns are ignored, whatever their names; an
    empty table gives an empty result. A text of any length is blocks of fixed size."""
    known = stored(identities(docs, id_column, text_column, block_bytes), "identities")
    groups = known.groupBy("n", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("_id", "row")).alias("best")
    )
    return known.join(groups, ["n", "name"]).select(
        F.col("_id").alias(id_column),
        F.col("best._id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = 4096
) -> DataFrame:
    """The rows that stay, with all columns, of any type. Rows that repeat an id and its
    text are one row: the one that reads least as JSON stays."""
    kept = (
        exact_duplicates(docs, id_column, text_column, block_bytes)
        .where("kept")
        .select(F.col(id_column).alias("_id"), F.col("text_sha256").alias("_sha"))
    )
    text = F.coalesce(F.col(text_column), F.lit(""))
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sha = F.sha2(lower.cast("binary"), 256)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), sha.alias("_sha"))
    marked = marked.withColumn("_id", F.col(f"_doc.`{id_column}`"))
    both = marked.join(
        kept.withColumnRenamed("_sha", "_s").withColumnRenamed("_id", "_i"),
        (F.col("_sha") == F.col("_s")) & F.col("_id").eqNullSafe(F.col("_i")),
        "left_semi",
    )
    rest = [F.col(f"_doc.`{c}`") for c in docs.columns if c != text_column]
    order = Window.partitionBy("_sha", "_id").orderBy(F.to_json(F.struct(*rest)))
    return (
        both.withColumn("_n", F.row_number().over(order))
        .where("_n = 1")
        .select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
    )
