"""Jaccard self-join on word n-grams with token-combination prefixes.

A document is its set of distinct shingles. Two sets x, y with similarity t or more lose
at most |x| - t|x| shingles of x, so if the rarest shingles of x carry more than that many
signatures, one signature survives in y as well. Following the k-wise signatures of Wang,
Xiao and Qin (2016), a rare shingle is a signature by itself, while frequent shingles,
which many unrelated documents share, count only in pairs of one subclass, and the prefix
is extended until enough signatures would have to be destroyed. Documents that share a
signature are candidates; all candidates are verified on their sets.

1. ``_spell``: each task shingles its documents, drops sets it has seen, and sends sorted
   48-bit shingle hashes with 16-bit document numbers, packed, to ranges of hashes.
   A shingle that is frequent within one task is sent as a mark only, so no range
   receives the occurrences of a common line.
2. ``_shared``: each range counts in how many sets a shingle occurs and returns those that
   occur in two or more: nothing else can be shared.
3. ``_candidates``: per set, its shared shingles in order of frequency; sets of which too
   much is unshared are done. The others get signatures.
4. Signature stars give groups of candidates; a group is verified in blocks of bounded
   size, and a block returns a spanning forest of its links, never its pairs.

Sets are compared by 64-bit shingle hashes (48 bits in step 2 on).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayscout.llm.shared import components, stored

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: odd multipliers that join word hashes, and the finaliser's
_MULTIPLIERS = [0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 | 1 for i in range(1, 65)]
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: a task packs its shingles at so many, or at so many documents
FLUSH_SHINGLES, FLUSH_DOCUMENTS = 1_000_000, 65_535
#: a shingle in so many sets of one flush is frequent at once; one in more than
#: ``FREQUENT`` sets of all is frequent, too
LOCALLY_FREQUENT, FREQUENT = 64, 32
_MARK = 2**31 - 1
#: bytes of text behind one range of hashes: about a million shingles
RANGE_BYTES = 6 << 20
#: shingles, with 500 for a document, in a block of the verification
BLOCK = 600_000


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of runs of ``size`` words: A-Z lower-cased, words
    are what lies between spaces and the controls 9 to 13. A text of fewer words is one
    run; one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words) + 1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - size + 1
    out = h[:n] * np.uint64(_MULTIPLIERS[0])
    for i in range(1, size):
        out += h[i : i + n] * np.uint64(_MULTIPLIERS[i])
    out = _mixed(out)
    out.sort()
    keep = np.ones(n, bool)
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


_SENT = "bucket int, kind int, base long, tokens binary, numbers binary"
_HELD = "kind int, node long, a long, b long, c long, n int"


def _six(tokens: np.ndarray) -> bytes:
    """The upper 48 bits, six bytes each."""
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _long(packed: bytes) -> np.ndarray:
    raw = np.zeros((len(packed) // 6, 8), np.uint8)
    raw[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return raw.reshape(-1).view(np.int64)


def _spell(buckets: int, size: int):
    """Packed rows. kind 0: shingles and the documents they are in; 1: shingles that are
    frequent here; 2: the occurrences of those, which need no counting; 3: documents."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        serial = itertools.count()
        sets: list[np.ndarray] = []
        seen: dict[bytes, int] = {}
        members: list[tuple] = []
        held = 0

        def flush() -> Iterator[pd.DataFrame]:
            flush_no = (part << 24) + next(serial)
            base = flush_no << 16
            rows = []
            if sets:
                tokens = np.concatenate(sets)
                numbers = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
                order = np.argsort(tokens, kind="stable")
                tokens, numbers = tokens[order], numbers[order]
                cut = np.flatnonzero(tokens[1:] != tokens[:-1]) + 1
                starts = np.concatenate(([0], cut))
                counts = np.diff(np.concatenate((starts, [len(tokens)])))
                often = counts >= LOCALLY_FREQUENT
                if often.any():
                    mask = np.repeat(often, counts)
                    # numbered by the flush: frequent occurrences are dealt evenly
                    rows.append((flush_no % buckets, 2, base, _six(tokens[mask]), numbers[mask].tobytes()))
                    for b, marks in _by_range(tokens[starts[often]], edges):
                        rows.append((b, 1, base, _six(marks[0]), b""))
                    tokens, numbers = tokens[~mask], numbers[~mask]
                for b, (t, d) in _by_range(tokens, edges, numbers):
                    rows.append((b, 0, base, _six(t), d.tobytes()))
            table = np.array([m[1:] for m in members], np.int64)
            known = np.array([m[0] is not None for m in members], np.int64)
            ids = np.array([m[0] or 0 for m in members], np.int64)
            packed = np.column_stack((known, ids, table)).tobytes()
            rows.append(((flush_no + 1) % buckets, 3, base, packed, b""))
            for i in range(0, len(rows), 16):
                yield pd.DataFrame(rows[i : i + 16], columns=_names(_SENT), dtype=object)

        for batch in batches:
            for known, key, text in zip(batch["_known"], batch["_id"], batch["_text"], strict=True):
                s = shingle_set(text, size)
                key = int(key) if known else None
                digest = xxhash.xxh3_128_digest(s.tobytes())
                number = -1
                if len(s) and key is not None:
                    number = seen.setdefault(digest, len(sets))
                    if number == len(sets):
                        sets.append(s)
                        held += len(s)
                high, low = np.frombuffer(digest, np.int64).tolist()
                members.append((key, number, high, low, len(s)))
                if held >= FLUSH_SHINGLES or len(members) >= FLUSH_DOCUMENTS:
                    yield from flush()
                    sets, seen, members, held = [], {}, [], 0
        if members:
            yield from flush()

    return run


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(",")]


def _by_range(tokens: np.ndarray, edges: np.ndarray, *more: np.ndarray):
    """(bucket, parts) of sorted tokens."""
    at = np.concatenate(([0], np.searchsorted(tokens, edges, "left"), [len(tokens)]))
    for b in np.flatnonzero(np.diff(at)):
        cut = slice(at[b], at[b + 1])
        yield int(b), (tokens[cut], *[m[cut] for m in more])


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one range: kind 0, node, a shingle in two or more sets, in how many; kinds 1 and
    2: documents with and without an id, their number, digest and size."""
    out = []
    kinds = rows["kind"].to_numpy(int)
    bases = rows["base"].to_numpy(np.int64)
    parts = [
        (_long(t), base + np.frombuffer(d, np.uint16).astype(np.int64), kind)
        for kind, base, t, d in zip(kinds, bases, rows["tokens"], rows["numbers"], strict=True)
        if kind in (0, 2)
    ]
    counted = [p for p in parts if p[2] == 0]
    if counted:
        tokens = np.concatenate([p[0] for p in counted])
        nodes = np.concatenate([p[1] for p in counted])
        order = np.argsort(tokens, kind="stable")
        tokens, nodes = tokens[order], nodes[order]
        starts = np.concatenate(([0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1))
        counts = np.diff(np.concatenate((starts, [len(tokens)])))
        marks = [_long(t) for kind, t in zip(kinds, rows["tokens"], strict=True) if kind == 1]
        if marks:
            counts_out = np.where(np.isin(tokens[starts], np.concatenate(marks)), _MARK, counts)
        else:
            counts_out = counts
        keep = np.repeat(counts_out >= 2, counts)
        out.append((0, nodes[keep], tokens[keep], np.repeat(counts_out, counts)[keep]))
    for tokens, nodes, kind in parts:
        if kind == 2:
            out.append((0, nodes, tokens, np.full(len(tokens), _MARK, np.int64)))
    frames = [pd.DataFrame({"kind": k, "node": v, "a": t, "b": f, "c": 0, "n": 0}) for k, v, t, f in out]
    for kind, base, packed in zip(kinds, bases, rows["tokens"], strict=True):
        if kind == 3:
            t = np.frombuffer(packed, np.int64).reshape(-1, 6)
            frames.append(
                pd.DataFrame(
                    {"kind": 2 - t[:, 0], "node": base + t[:, 2], "a": t[:, 1], "b": t[:, 3], "c": t[:, 4], "n": t[:, 5]}
                )
            )
    return pd.concat(frames, ignore_index=True)[_names(_HELD)]


def _runs(batches: Iterator[pd.DataFrame], keys: int) -> Iterator[list[np.ndarray]]:
    """Groups of a stream that is sorted by its first ``keys`` columns, whole over the cuts
    of its batches: an array per column."""
    rest: list[np.ndarray] | None = None
    for b in batches:
        if not len(b):
            continue
        columns = [b[c].to_numpy() for c in b.columns]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        changed = np.zeros(len(columns[0]) - 1, bool)
        for c in columns[:keys]:
            changed |= c[1:] != c[:-1]
        ends = [0, *(np.flatnonzero(changed) + 1).tolist()]
        for i, j in zip(ends[:-1], ends[1:], strict=True):
            yield [c[i:j] for c in columns]
        rest = [c[ends[-1] :] for c in columns]
    if rest is not None:
        yield rest


def signatures(tokens: np.ndarray, counts: np.ndarray, n: int, percent: int, frequent: int) -> list[int]:
    """Signatures of a set of ``n`` shingles of which ``tokens``, ordered by (counts,
    token), are shared with others. Empty if no other set can be similar enough.

    With similarity ``percent``, at most ``lost`` shingles are not in the other set. The
    unshared ones come first in the order and are signatures that nothing else has. Then
    come rare ones, each a signature, and then frequent ones in subclasses, of which m
    in the prefix are worth m - 1: so many must be lost to leave no pair. The subclasses
    follow the size class of the smaller of the two sets, so each set signs for its own
    size class and for that of its smallest partner."""
    lost = n - -(-percent * n // 100)
    need = lost + 1 - (n - len(tokens))
    if need <= 0:
        return []
    rare = int(np.searchsorted(counts, frequent, "right")) if n > 1 else len(tokens)
    out = []
    for band in {n.bit_length() - 1, (-(-percent * n // 100)).bit_length() - 1}:
        single = tokens[: min(rare, need)].astype(np.uint64)
        out.append(_mixed(single * np.uint64(_MULTIPLIERS[0]) + np.uint64(band)))
        left = need - len(single)
        if left <= 0:
            continue
        subclasses = max(1, (1 << band) // 8)
        often = tokens[rare:].astype(np.uint64)
        where = (_mixed(often) % np.uint64(subclasses)).astype(np.int64)
        # worth grows by one with each token but the first of a subclass
        first = np.zeros(len(often), bool)
        first[np.unique(where, return_index=True)[1]] = True
        worth = np.cumsum(~first)
        end = int(np.searchsorted(worth, left, "left")) + 1
        if end > len(often):
            raise AssertionError("a prefix ran out of shingles")
        by_class: dict[int, list[int]] = {}
        for c, t in zip(where[:end].tolist(), often[:end], strict=True):
            by_class.setdefault(c, []).append(t)
        for group in by_class.values():
            if len(group) > 1:
                g = np.sort(np.array(group, np.uint64))
                i, j = np.triu_indices(len(g), 1)
                pair = g[i] * np.uint64(_MULTIPLIERS[1]) + g[j] * np.uint64(_MULTIPLIERS[2])
                out.append(_mixed(pair + np.uint64(band)))
    return np.unique(np.concatenate(out)).view(np.int64).tolist() if out else []


def _candidates(percent: int, frequent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        held = 0
        for _, counts, tokens, sizes in _runs(batches, 1):
            n = int(sizes[0])  # of the row that describes the set, with a count of -1
            if n == 0 or (len(tokens) - 1) * 100 < percent * n:
                continue
            marks = signatures(tokens[1:], counts[1:], n, percent, frequent)
            if marks:
                rows.append((int(tokens[0]), n, np.sort(tokens[1:]).tobytes(), marks))
                held += len(tokens) + len(marks)
            if held > 500_000:
                yield pd.DataFrame(rows, columns=["id", "n", "tokens", "marks"], dtype=object)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["id", "n", "tokens", "marks"], dtype=object)

    return run


def linked(sets: list[np.ndarray], sizes: np.ndarray, percent: int, split: int | None = None) -> np.ndarray:
    """For each set the least number of a set it is connected to by links; with ``split``,
    only links between sets before and from that number on count. Intersections come from
    products of 0/1 matrices, some columns at a time."""
    d = len(sets)
    owner = np.repeat(np.arange(d), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], often[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((d, d), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, 2048):
        i, j = np.searchsorted(column, (low, low + 2048))
        part = np.zeros((d, min(2048, width - low)), np.float32)
        part[owner[i:j], column[i:j] - low] = 1
        both += part @ part.T
    either = sizes[:, None] + sizes[None, :] - both
    near = both * 100 >= percent * either
    if split is not None:
        near[:split, :split] = False
        near[split:, split:] = False
    np.fill_diagonal(near, True)
    label = np.arange(d)
    while True:
        least = np.where(near, label[None, :], d).min(1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _verify(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_a, ids_b = [], []
        for _, i, j, block, ids, sizes, tokens in _runs(batches, 3):
            if len(ids) < 2:
                continue
            order = np.argsort(block, kind="stable")
            ids, sizes = ids[order], sizes[order].astype(np.float32)
            sets = [np.frombuffer(tokens[k], np.int64) for k in order]
            split = None if i[0] == j[0] else int((block == i[0]).sum())
            label = linked(sets, sizes, percent, split)
            moved = label != np.arange(len(ids))
            ids_a.append(ids[moved])
            ids_b.append(ids[label[moved]])
            if sum(map(len, ids_a)) > 10_000:
                yield pd.DataFrame({"a": np.concatenate(ids_a), "b": np.concatenate(ids_b)})
                ids_a, ids_b = [], []
        if ids_a:
            yield pd.DataFrame({"a": np.concatenate(ids_a), "b": np.concatenate(ids_b)})

    return run


def _blocks(candidates: DataFrame, groups: DataFrame, percent: int, block: int) -> DataFrame:
    """Each candidate once for every pair of blocks (i, j) of its group that it belongs to.
    Blocks follow the sizes of the sets: pairs of blocks whose sizes lie too far apart for
    any link are left out."""
    order = Window.partitionBy("component").orderBy("n", "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(
        candidates.select("id", "n")
        .join(groups, "id")
        .withColumn("block", F.floor(F.sum(F.col("n") + 500).over(order) / block).cast("int")),
        "blocks",
    )
    spans = placed.groupBy("component", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    left = spans.select("component", F.col("block").alias("i"), "high")
    right = spans.select("component", F.col("block").alias("j"), "low")
    pairs = (
        left.join(right, "component")
        .where((F.col("i") <= F.col("j")) & (F.col("high") * 100 >= F.col("low") * percent))
        .select("component", "i", "j")
    )
    roles = pairs.select("component", F.col("i").alias("block"), "i", "j").unionByName(
        pairs.where("i < j").select("component", F.col("j").alias("block"), "i", "j")
    )
    return placed.join(roles, ["component", "block"]).join(candidates.select("id", "tokens"), "id")


def similar_groups(
    docs: DataFrame,
    percent: int = 75,
    size: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
    frequent: int = FREQUENT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id: the least id that links
    reach. Sets x, y link when 100 |x and y| >= percent |x or y|.

    Ids are integers. Null, empty and blank texts have no shingles and link with nothing,
    not even each other. A row without an id has no component. Rows that share an id are
    one node, linked by any of their texts. Equal texts link and cost one set; other
    columns are ignored; an empty table gives an empty result. The longest text that fits
    a row is shingled whole."""
    total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    buckets = max(32, -(-total // RANGE_BYTES))
    given = F.col(id_column).cast("long")
    sent = docs.select(
        given.isNotNull().alias("_known"), F.coalesce(given, F.lit(0)).alias("_id"), F.col(text_column).alias("_text")
    ).mapInPandas(_spell(buckets, size), _SENT)
    held = stored(sent.groupBy("bucket").applyInPandas(_shared, _HELD), "shared")
    members = held.where("kind > 0").select(
        "kind", "node", F.col("a").alias("id"), F.col("b").alias("high"), F.col("c").alias("low"), "n"
    )
    # one set of all equal ones stands for them, under their least id
    classes = stored(
        members.where("kind = 1 and n > 0")
        .groupBy("high", "low")
        .agg(F.min("id").alias("rep"), F.min("node").alias("node"), F.first("n").alias("n")),
        "classes",
    )
    # the row that describes a set comes first of its node's; nodes of copies have none
    postings = held.where("kind = 0").select("node", F.col("b").alias("df"), F.col("a").alias("token"), F.lit(0).alias("n"))
    heads = classes.select("node", F.lit(-1).cast("long"), "rep", "n")
    sorted_ = postings.union(heads).repartition("node").sortWithinPartitions("node", "df", "token")
    candidates = stored(
        sorted_.mapInPandas(
            _candidates(percent, frequent), "id long, n int, tokens binary, marks array<long>"
        ),
        "candidates",
    )
    marks = candidates.select("id", F.explode("marks").alias("mark"))
    hubs = marks.groupBy("mark").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
    stars = marks.join(hubs.where("hub < last"), "mark").select(
        F.col("id").alias("a"), F.col("hub").alias("b")
    )
    groups = components(stars)
    pairs = _blocks(candidates, groups, percent, block)
    links = pairs.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    links = links.select("component", "i", "j", "block", "id", "n", "tokens")
    # an id with several texts is one node: the classes of its texts are linked through it
    own, text = members.where("kind = 1 and n > 0"), F.struct("high", "low")
    several = own.groupBy("id").agg(F.min(text).alias("x"), F.max(text).alias("y")).where("x <> y").select("id")
    named = (
        own.join(several, "id", "left_semi")
        .join(classes.select("high", "low", "rep"), ["high", "low"])
        .select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )
    links = links.mapInPandas(_verify(percent), "a long, b long").unionByName(named)
    found = components(links)
    reached = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "high", "low", F.coalesce("component", "rep").alias("component")
    )
    return members.join(reached, ["high", "low"], "left").select(
        F.when(F.col("kind") == 1, F.col("id")).alias(id_column),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("kind") == 1, F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias(
            "component_id"
        ),
    )


def one_of_each_group(
    docs: DataFrame, percent: int = 75, size: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows whose id is the least of their group, with all columns, and the rows without
    an id. Edge cases as in ``similar_groups``."""
    groups = similar_groups(docs, percent, size, id_column, text_column)
    gone = groups.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias("_gone")).distinct()
    same = F.col(f"d.`{id_column}`") == F.col("g._gone")
    return docs.alias("d").join(gone.alias("g"), same, "left_anti").select("d.*")
