"""A prefix trie of conversations rebuilt from two parts, by composable fingerprints.

A sequence of turns has the fingerprint (length, value). Two of them combine to
``(m + n, value_a * B**n + value_b)`` modulo a prime, which is associative and, since B has
powers only, lets a known beginning be taken off again. So the prefix of a conversation
that has the head of a base and a suffix of its own comes from three stored values: the
base's head, the own prefix, and the own head that is replaced. No rebuilt text exists
anywhere; a rebuilt turn is a reference to a stored one.

Prefixes with one depth and fingerprint form a group. Equality is verified, not assumed:
the members of a group must refer to stored turns of one class and have one parent group,
and stored turns of one class must have equal role and text, compared as they are. By
induction over the depth the members then begin alike. Should a hash ever bring two
different turns or prefixes together, the next seed is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayscout.llm.shared import stored

P = (1 << 127) - 1
#: parts of a class of equal turns when their texts are compared
SALTS = 16
_LOW = (1 << 64) - 1

Element = tuple[int, int]


def base(seed: int) -> int:
    """B for a seed."""
    return int.from_bytes(hashlib.sha256(f"base {seed}".encode()).digest()) % P


def combined(b: int, left: Element, right: Element) -> Element:
    """The fingerprint of two sequences one after the other."""
    return left[0] + right[0], (left[1] * pow(b, right[0], P) + right[1]) % P


def _halves(values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Values below 2**127 as two signed 64-bit columns."""
    low = np.array([v & _LOW for v in values], np.uint64).view(np.int64)
    return np.array([v >> 64 for v in values], np.int64), low


def _values(high, low) -> list[int]:
    return [(a << 64) | (b & _LOW) for a, b in zip(high.tolist(), low.tolist(), strict=True)]


class _Powers:
    """Powers of B; the small ones are kept."""

    def __init__(self, b: int):
        self.b, self.small = b, [1]
        for _ in range(1024):
            self.small.append(self.small[-1] * b % P)

    def __call__(self, n: int) -> int:
        return self.small[n] if n <= 1024 else pow(self.b, n, P)


_TURN = "conv_id long, part int, place long, before1 long, before2 long, f1 long, f2 long, d1 long, d2 long, words long"


def _prefixes(b: int):
    """Places and prefix fingerprints within the rows that a task has of a conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        conv, place, value = None, 0, 0
        for rows in batches:
            places, before, after = [], [], []
            turns = _values(rows["d1"], rows["d2"])
            for c, turn in zip(rows["conv_id"].tolist(), turns, strict=True):
                if c != conv:
                    conv, place, value = c, 0, 0
                place += 1
                before.append(value)
                value = (value * b + turn) % P
                places.append(place)
                after.append(value)
            out = rows[["conv_id", "d1", "d2", "words"]].assign(part=part, place=places)
            out["before1"], out["before2"] = _halves(before)
            out["f1"], out["f2"] = _halves(after)
            yield out[[f.split()[0] for f in _TURN.split(", ")]]

    return run


def _carried(b: int, carry: dict[int, tuple[int, int, int]]):
    """The same over all tasks: the first conversation of a part may have begun before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        power = _Powers(b)
        for rows in batches:
            moved = [
                i for i, (part, c) in enumerate(zip(rows["part"], rows["conv_id"], strict=True))
                if part in carry and carry[part][0] == c
            ]
            if moved:
                rows = rows.copy()
                at = rows.index[moved]
                some = rows.loc[at]
                lead = [carry[part] for part in some["part"]]
                for one, two, less in (("before1", "before2", 1), ("f1", "f2", 0)):
                    values = [
                        (v * power(n - less) + own) % P
                        for (_, _, v), n, own in zip(lead, some["place"].tolist(), _values(some[one], some[two]), strict=True)
                    ]
                    rows.loc[at, one], rows.loc[at, two] = _halves(values)
                rows.loc[at, "place"] = some["place"] + [n for _, n, _ in lead]
            yield rows

    return run


def _order() -> list[Column]:
    return [F.col(c) for c in ("conv_id", "turn", "role", "_head", "_hash")]


def _turns(conversations: DataFrame, seed: int) -> DataFrame:
    """Turns without texts: conv_id, role, words, a class of 128 bits, and sort keys."""
    words = r"[^\x20\x09-\x0D]+"
    return (
        conversations.where("conv_id IS NOT NULL")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .select(
            "*",
            F.substring("text", 1, 32).alias("_head"),
            F.xxhash64("text").alias("_hash"),
            # 63 and 64 bits
            F.shiftrightunsigned(F.xxhash64(F.lit(2 * seed), "role", "text"), 1).alias("d1"),
            F.xxhash64(F.lit(2 * seed + 1), "role", "text").alias("d2"),
            F.regexp_count("text", F.lit(words)).cast("long").alias("words"),
        )
    )


def _stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """The stored turns with their places (from 1) and own prefix fingerprints. Ranges of
    (conv_id, turn, ...) split a long conversation; a part's end is one row for the
    driver, as many as there are tasks."""
    b = base(seed)
    keys = _order()
    local = stored(
        _turns(conversations, seed)
        .drop("text")
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys, "d1", "d2")
        .select("conv_id", "d1", "d2", "words")
        .mapInPandas(_prefixes(b), _TURN),
        "turns",
    )
    ends = local.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place", "f1", "f2")).alias("end")
    )
    carry: dict[int, tuple[int, int, int]] = {}
    open_: tuple[int, Element] | None = None
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        own = (r["end"]["place"], (r["end"]["f1"] << 64) | (r["end"]["f2"] & _LOW))
        if open_ and open_[0] == r["first"]:
            carry[r["part"]] = (open_[0], *open_[1])
            if r["end"]["conv_id"] == r["first"]:
                own = combined(b, open_[1], own)
        open_ = r["end"]["conv_id"], own
    return local.mapInPandas(_carried(b, carry), _TURN) if carry else local


_MEMBER = (
    "conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, d1 long, d2 long, words long,"
    " ref_conv long, ref_place long, is_end boolean"
)
_MEMBER_NAMES = [f.split()[0] for f in _MEMBER.replace(", ", ",").split(",")]


def _own_members(b: int):
    """Rebuilt prefixes that end in an own turn: the base's head in place of the own one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        power = _Powers(b)
        for r in batches:
            gap = [x - y for x, y in zip(_values(r["h1"], r["h2"]), _values(r["o1"], r["o2"]), strict=True)]
            beyond = (r["place"] - r["own_head"]).tolist()
            out = r[["conv_id", "d1", "d2", "words"]].assign(
                depth=r["head"] + r["place"] - r["own_head"], ref_conv=r["conv_id"], ref_place=r["place"]
            )
            out["is_end"] = out["depth"] == r["turns"]
            for one, two, less, x, y in (("f1", "f2", 0, "f1", "f2"), ("p1", "p2", 1, "before1", "before2")):
                own = _values(r[x], r[y])
                values = [(g * power(k - less) + v) % P for g, k, v in zip(gap, beyond, own, strict=True)]
                out[one], out[two] = _halves(values)
            yield out[_MEMBER_NAMES]

    return run


def _members(turns: DataFrame, seed: int, every: int, heads: int) -> DataFrame:
    """A row per conversation and depth of its rebuilt form, the root included."""
    take = F.crc32(F.col("conv_id").cast("string")) % heads
    zero = F.lit(0).cast("long")
    own = turns.groupBy("conv_id").agg(
        F.max("place").alias("n"),
        F.coalesce(F.max(F.when(F.col("place") == take, F.col("f1"))), zero).alias("o1"),
        F.coalesce(F.max(F.when(F.col("place") == take, F.col("f2"))), zero).alias("o2"),
    )
    first = (
        turns.where((F.col("conv_id") % every == 0) & (F.col("place") < heads))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(
            F.array_sort(
                F.collect_list(F.struct("place", "f1", "f2", "before1", "before2", "d1", "d2", "words"))
            ).alias("begin")
        )
    )
    convs = (
        own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "own_head": take})
        .join(first, "base", "left")
        .withColumn("begin", F.expr("CASE WHEN begin IS NULL OR own_head = 0 THEN array() ELSE slice(begin, 1, CAST(own_head AS INT)) END"))
        .withColumn("head", F.size("begin").cast("long"))
        .withColumn("turns", F.col("head") + F.greatest(F.col("n") - F.col("own_head"), zero))
    )
    convs = stored(convs, "rebuilt")
    last = F.try_element_at("begin", F.lit(-1))
    ends = convs.select(
        "conv_id", "own_head", "head", "turns", "o1", "o2",
        F.coalesce(last["f1"], zero).alias("h1"), F.coalesce(last["f2"], zero).alias("h2"),
    )
    suffix = (
        turns.where(F.col("place") > take)
        .join(ends, "conv_id")
        .mapInPandas(_own_members(base(seed)), _MEMBER)
    )
    shared = convs.select("conv_id", "base", "turns", F.explode("begin").alias("t")).select(
        "conv_id",
        F.col("t.place").alias("depth"), F.col("t.f1").alias("f1"), F.col("t.f2").alias("f2"),
        F.col("t.before1").alias("p1"), F.col("t.before2").alias("p2"),
        F.col("t.d1").alias("d1"), F.col("t.d2").alias("d2"), F.col("t.words").alias("words"),
        F.col("base").alias("ref_conv"), F.col("t.place").alias("ref_place"),
        (F.col("t.place") == F.col("turns")).alias("is_end"),
    )
    root = convs.select(
        "conv_id", *[zero.alias(c) for c in _MEMBER_NAMES[1:9]],
        F.lit(None).cast("long").alias("ref_conv"), F.lit(None).cast("long").alias("ref_place"),
        (F.col("turns") == 0).alias("is_end"),
    )
    return stored(suffix.unionByName(shared).unionByName(root), "members")


def _groups(members: DataFrame) -> DataFrame:
    """Groups of prefixes, with what shows whether they are of one class and parent."""
    return stored(
        members.groupBy("depth", "f1", "f2").agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            *[F.min(c).alias(c) for c in ("p1", "p2", "d1", "d2", "words")],
            *[F.max(c).alias(f"other_{c}") for c in ("p1", "p2", "d1", "d2")],
            F.min(F.struct("ref_conv", "ref_place")).alias("ref"),
        ),
        "groups",
    )


def _equal(conversations: DataFrame, turns: DataFrame, groups: DataFrame, seed: int) -> bool:
    """Whether all members of every group begin alike. Classes that several stored turns
    share are compared by role and text; least and greatest are enough."""
    differs = " OR ".join(f"{c} <> other_{c}" for c in ("p1", "p2", "d1", "d2"))
    if not groups.where(differs).isEmpty():
        return False
    several = turns.groupBy("d1", "d2").agg(F.count("*").alias("k")).where("k > 1").select("d1", "d2")
    # a class with many turns, such as a common first one, is read by several tasks
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(SALTS)).cast("int")
    turn = F.struct("role", "text")
    texts = (
        _turns(conversations, seed)
        .withColumn("salt", salt)
        .join(stored(several, "classes").select("d1", "d2", salts), ["d1", "d2", "salt"], "left_semi")
        .groupBy("d1", "d2", "salt")
        .agg(F.min(turn).alias("least"), F.max(turn).alias("greatest"))
        .groupBy("d1", "d2")
        .agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    )
    return texts.where("least <> greatest").isEmpty()


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (node, conv_id) rows as strings of up to a thousand ids."""
    from pyspark import TaskContext

    part, names = TaskContext.get().partitionId(), ["depth", "f1", "f2", "part", "k", "ids"]
    k = 0
    for b in batches:
        if not len(b):
            continue
        keys = b[["depth", "f1", "f2"]].to_numpy(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        cuts = sorted({*new.tolist(), *range(0, len(b), 1000)})
        ids, out = b["conv_id"].tolist(), []
        for s, e in zip(cuts, [*cuts[1:], len(b)], strict=True):
            out.append((*keys[s].tolist(), part, k, ",".join(map(str, ids[s:e]))))
            k += 1
        yield pd.DataFrame(out, columns=names)


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest per node over its strings in order."""
    names = ["depth", "f1", "f2", "ends_sha256"]
    node, digest, out = None, None, []
    for b in batches:
        for *key, ids in zip(b["depth"].tolist(), b["f1"].tolist(), b["f2"].tolist(), b["ids"], strict=True):
            if key != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 10_000:
            yield pd.DataFrame(out, columns=names)
            out = []
    if node:
        out.append((*node, digest.hexdigest()))
    yield pd.DataFrame(out, columns=names)


def _end_digests(members: DataFrame) -> DataFrame:
    node = ["depth", "f1", "f2"]
    runs = (
        members.where("is_end")
        .select(*node, "conv_id")
        .repartitionByRange(*node, "conv_id")
        .sortWithinPartitions(*node, "conv_id")
        .mapInPandas(_runs, "depth long, f1 long, f2 long, part int, k long, ids string")
    )
    return (
        runs.repartition(*node)
        .sortWithinPartitions(*node, "part", "k")
        .mapInPandas(_chained, "depth long, f1 long, f2 long, ends_sha256 string")
    )


def _running(nodes: DataFrame, block: int = 4096) -> DataFrame:
    """(depth, f1, f2, earlier): what the nodes above a node save that have the same least
    member. Sums within blocks of depths, and over blocks, so no window holds more than a
    block however long a conversation is."""
    here = nodes.select("depth", "f1", "f2", "conv_id", "saved", F.floor(F.col("depth") / block).alias("block"))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = here.groupBy("conv_id", "block").agg(F.sum("saved").alias("s"))
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("s").over(over), F.lit(0)).alias("above"))
    own = here.withColumn("own", F.coalesce(F.sum("saved").over(inside), F.lit(0)))
    return own.join(blocks, ["conv_id", "block"]).select(
        "depth", "f1", "f2", (F.col("own") + F.col("above")).alias("earlier")
    )


def prefix_trie(conversations: DataFrame, every: int = 20, heads: int = 4, seeds: int = 8) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, ref_conv_id and ref_turn (a stored
    turn that the node ends in, counted from 1; null for the root).

    A conversation c is rebuilt as the first h stored turns of conversation c - c % every
    and its own turns after its first h, with h = crc32(c) % heads. Turns are taken by
    turn, nulls first, and within one turn by role, then text; null role and text are
    empty; repeated rows are turns of their own. Rows without conv_id belong to no
    conversation. Other columns are ignored. An empty table has no nodes, not even a root.

    A node's leaves, and what is saved below it, are sums over its members: each leaf and
    each saving is charged to the least member of its node, so two aggregates replace a
    walk over the depth, and a conversation of any length needs no round of its own."""
    for seed in range(seeds):
        turns = _stored_turns(conversations, seed)
        members = _members(turns, seed, every, heads)
        groups = _groups(members)
        if _equal(conversations, turns, groups, seed):
            return _tree(members, groups)
    raise RuntimeError(f"{seeds} seeds gave collisions")


def _tree(members: DataFrame, groups: DataFrame) -> DataFrame:
    node = ["depth", "f1", "f2"]
    children = (
        groups.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = stored(
        groups.join(children, node, "left").select(
            *node, "conv_id", "n_convs", "p1", "p2", "ref",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "nodes",
    )
    charged = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("total"), F.count_if(F.col("n_children") == 0).alias("leaf")
    )
    sums = (
        members.select("conv_id", *node)
        .join(charged, "conv_id")
        .groupBy(*node)
        .agg(F.sum("total").alias("total"), F.sum("leaf").alias("n_leaves"))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    ).where("depth > 1")
    root = nodes.where("depth = 0").first()
    below_root = F.when(F.col("depth") == 1, F.lit(root["conv_id"] if root else None))
    # nothing is below the root by a join: it has the most children by far
    return (
        nodes.join(sums, node)
        .join(_running(nodes), node)
        .join(_end_digests(members), node, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth",
            F.coalesce(below_root, F.col("parent_conv_id")).cast("long").alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves",
            (F.col("total") - F.col("earlier")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
            F.col("ref.ref_conv").alias("ref_conv_id"), F.col("ref.ref_place").alias("ref_turn"),
        )
    )
