"""Repair of the turn structure of conversations by weighted CYK interval parsing.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``. With the
states 0 (start), 1 (after s), 2 (after u) and 3 (after a), a nonterminal ``pq`` stands for
rows and insertions that lead from state p to state q. The grammar is in Chomsky normal
form: ``pr -> pq qr``, and ``pq -> row``, where a row is kept, gets another role, or is
deleted. Insertions have no rows; their closure is folded into the cells of single rows,
on either side. The start symbols are ``00`` and ``03``.

A cell holds the least (cost, audit) of a nonterminal over a span of rows; the audit names
the edits by their initials. The letters of an audit fix its cost, so no audit of a cell
begins another one of equal cost, and the least of a joined span is made of the least of
its parts. Cells are combined bottom-up by span length. Since every state may stand
between two rows, each derivation can be cut anywhere: spans of up to ``BLOCK`` rows try
every split, in one numpy chart for all blocks of a batch, and longer spans join two
neighbours, twice as long at each level. A conversation that lies in several tasks meets
as one span a task, never as rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayscout.llm.shared import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: rows of a block: 24 letters hold any least audit over so many rows
BLOCK = 8

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
CELLS = [(p, q) for p, reach in enumerate(((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))) for q in reach]
#: insertions that lead from one state to another
INSERTIONS = {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1} | {(p, p): 0 for p in range(4)}
#: pr -> pq qr as places in CELLS, the rules of one pr together
RULES = [
    (CELLS.index((p, r)), CELLS.index((p, q)), CELLS.index((q, r)))
    for p, r in CELLS
    for q in range(4)
    if (p, q) in CELLS and (q, r) in CELLS
]
INITIALS = "sua"

Cell = tuple[int, bytes] | None


def row_cells(initial: str, must_go: bool, truncated: bool) -> list[Cell]:
    """The cells of one row, insertions beside it included."""
    own: dict[tuple[int, int], tuple[int, bytes]] = {}

    def offer(at: tuple[int, int], cost: int, audit: bytes) -> None:
        own[at] = min(own.get(at, (1 << 60, b"")), (cost, audit))

    for p in range(4):
        offer((p, p), DELETE, b"D")
    more = TRUNCATED if truncated else 0
    for (p, role), q in STEP.items() if not must_go else ():
        if role == initial:
            offer((p, q), KEEP + more, b"K")
        if role != "s":
            offer((p, q), REROLE + more, b"R")
    out: list[Cell] = []
    for p, q in CELLS:
        ways = [
            (INSERT * (INSERTIONS[p, a] + INSERTIONS[b, q]) + cost, b"I" * INSERTIONS[p, a] + audit + b"I" * INSERTIONS[b, q])
            for (a, b), (cost, audit) in own.items()
            if (p, a) in INSERTIONS and (b, q) in INSERTIONS
        ]
        out.append(min(ways, default=None))
    return out


def joined(left: list[Cell], right: list[Cell]) -> list[Cell]:
    """Cells of two neighbouring spans as those of the span of both."""
    costs: list[int | None] = [None] * len(CELLS)
    ways: list[list[tuple[bytes, bytes]]] = [[] for _ in CELLS]
    for to, a, b in RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost = x[0] + y[0]
        if costs[to] is None or cost < costs[to]:
            costs[to], ways[to] = cost, [(x[1], y[1])]
        elif cost == costs[to]:
            ways[to].append((x[1], y[1]))
    return [
        None if c is None else (c, min(x + y for x, y in w))
        for c, w in zip(costs, ways, strict=True)
    ]


def whole(spans: list[list[Cell]]) -> list[Cell]:
    """Neighbouring spans joined in pairs, twice as long at each level."""
    while len(spans) > 1:
        odd = [spans[-1]] if len(spans) % 2 else []
        spans = [joined(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)] + odd
    return spans[0]


def best(cells: list[Cell]) -> tuple[int, str]:
    """The least (cost, audit) of the start symbols."""
    cost, audit = min(cells[CELLS.index(at)] for at in ((0, 0), (0, 3)))
    return cost, audit.decode()


# A cell of the chart is one number: cost (10 bits), up to 24 letters of two bits from the
# left, and their count (6 bits). Numbers are then ordered like (cost, audit).
_LETTERS = b"DIKR"
_AUDIT = np.uint64(((1 << 48) - 1) << 6)
_REST = ~_AUDIT
_COUNT = np.uint64(63)
_NONE = np.uint64(700 << 54)
_TO = np.array([to for to, _, _ in RULES])
_LEFT = np.array([a for _, a, _ in RULES])
_RIGHT = np.array([b for _, _, b in RULES])
_FIRST_RULE = np.flatnonzero(np.diff(_TO, prepend=-1))


def _number(cell: Cell) -> int:
    if cell is None:
        return int(_NONE)
    cost, audit = cell
    letters = sum(_LETTERS.index(c) << (46 - 2 * i) for i, c in enumerate(audit))
    return cost << 54 | letters << 6 | len(audit)


def _audits(numbers: np.ndarray) -> list[bytes]:
    shifts = np.arange(52, 5, -2, dtype=np.uint64)
    letters = np.frombuffer(_LETTERS, np.uint8)[((numbers[:, None] >> shifts) & np.uint64(3)).astype(np.intp)]
    raw, counts = letters.tobytes(), (numbers & _COUNT).tolist()
    return [raw[24 * i : 24 * i + n] for i, n in enumerate(counts)]


#: cells of single rows by kind: initial (s, u, a, other) * 3 + (right, truncated, must go)
_ROWS = np.array(
    [[_number(c) for c in row_cells(i, k == 2, k == 1)] for i in "sua?" for k in range(3)], np.uint64
).T


def chart(kinds: np.ndarray) -> np.ndarray:
    """Cells over the whole of each block; ``kinds`` has a line per block, all as long."""
    rows = kinds.shape[1]
    spans = {1: _ROWS[:, kinds]}
    for length in range(2, rows + 1):
        starts = rows - length + 1
        least = None
        for cut in range(1, length):
            x = spans[cut][:, :, :starts][_LEFT]
            y = spans[length - cut][:, :, cut : cut + starts][_RIGHT]
            moved = ((y & _AUDIT) >> ((x & _COUNT) << np.uint64(1))) & _AUDIT
            ways = ((x & _REST) + (y & _REST)) | (x & _AUDIT) | moved
            ways = np.minimum.reduceat(ways, _FIRST_RULE, axis=0)
            least = ways if least is None else np.minimum(least, ways)
        spans[length] = np.where(least >= _NONE, _NONE, least)
    return spans[rows][:, :, 0]


def _block_cells(kinds: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(cells, blocks) numbers of blocks of rows."""
    out = np.empty((len(CELLS), len(starts)), np.uint64)
    for n in np.unique(lengths):
        of = np.flatnonzero(lengths == n)
        for part in np.array_split(of, -(-len(of) // 4096)):  # bounds the chart
            out[:, part] = chart(kinds[starts[part][:, None] + np.arange(n)])
    return out


class Span:
    """What is known of consecutive rows of a conversation. Spans that follow each other
    add up."""

    COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self, counts, low, high, first, last, last_turn, first_turn, cells):
        self.counts = counts  # in the order of COUNTS
        self.low, self.high = low, high  # turns, None where there is none
        self.first, self.last = first, last  # codes of role initials
        self.first_turn, self.last_turn = first_turn, last_turn
        self.cells = cells  # None for no rows

    def then(self, other: Span) -> Span:
        if not self.counts[0] or not other.counts[0]:
            return other if not self.counts[0] else self
        counts = [a + b for a, b in zip(self.counts, other.counts, strict=True)]
        counts[4] += not _follows(self.last, other.first)
        counts[5] -= self.last_turn is not None and self.last_turn == other.first_turn
        turns = [t for t in (self.low, self.high, other.low, other.high) if t is not None]
        return Span(
            counts, min(turns, default=None), max(turns, default=None), self.first, other.last,
            other.last_turn, self.first_turn, joined(self.cells, other.cells),
        )

    def row(self, key: str) -> tuple:
        cost, audit = best(self.cells) if self.counts[0] else (0, "")
        rows, blank, duplicate, truncated, illegal, turns = self.counts
        gaps = 0 if self.low is None else self.high - self.low + 1 - turns
        return key, rows, gaps, blank, duplicate, truncated, illegal, cost, audit


def _follows(a, b):
    """Whether an initial may follow another, by their codes in INITIALS."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


_PARSE = "_c string, rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PARSE_NAMES = [f.split()[0] for f in _PARSE.split(", ")]
_PART = (
    f"{_PARSE}, part int, counts array<long>, low long, high long, first int, last int, last_turn long,"
    " first_turn long, costs array<long>, audits array<string>"
)
_PART_NAMES = [f.split()[0] for f in _PART.replace(", ", ",").split(",")]


def _batch_spans(b: pd.DataFrame) -> Iterator[tuple[str, Span | None, tuple | None]]:
    """(key, span, or the finished row of a short one) of each conversation of sorted rows,
    in their order. The first and the last have spans, since they may go on elsewhere."""
    key = b["_c"].to_numpy(object)
    many = b["m"].to_numpy(np.int64)
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    keys = key[new]
    at = np.repeat(np.repeat(np.arange(len(new)), np.diff(new, append=len(key))), many)
    row = np.repeat(np.arange(len(key)), many)
    again = np.ones(len(row), bool)
    again[(np.cumsum(many) - many)[many > 0]] = False
    blank = b["blank"].to_numpy(bool)[row]
    duplicate = ~blank & (again | ~b["is_first"].to_numpy(bool)[row])
    truncated = ~blank & ~duplicate & b["is_cut"].to_numpy(bool)[row]
    initial = b["initial"].to_numpy(np.int64)[row]
    turn, has = b["_turn"].to_numpy(np.int64)[row], b["has_turn"].to_numpy(bool)[row]
    n = len(keys)
    sums = lambda flags: np.bincount(at[flags], minlength=n)
    same = np.concatenate(([False], at[1:] == at[:-1])) if len(at) else np.zeros(0, bool)
    before = np.roll(initial, 1)
    illegal = same & ~_follows(before, initial)
    new_turn = has & ~(same & np.roll(has, 1) & (np.roll(turn, 1) == turn))
    counts = np.stack(
        [np.bincount(at, minlength=n), sums(blank), sums(duplicate), sums(truncated), sums(illegal), sums(new_turn)]
    )
    starts = np.searchsorted(at, np.arange(n))
    ends = np.searchsorted(at, np.arange(n), "right")
    kinds = initial * 3 + np.where(blank | duplicate, 2, truncated)
    blocks = -(-(ends - starts) // BLOCK)
    block_of = np.repeat(np.arange(n), blocks)
    first_block = np.cumsum(blocks) - blocks
    block_start = starts[block_of] + (np.arange(len(block_of)) - first_block[block_of]) * BLOCK
    cells = _block_cells(kinds, block_start, np.minimum(BLOCK, ends[block_of] - block_start))
    short = np.minimum(cells[CELLS.index((0, 0))], cells[CELLS.index((0, 3))])
    short_audits = _audits(short)
    short_costs = (short >> np.uint64(54)).tolist()
    # turns are sorted, nulls first: the last is the largest, the first that there is the least
    no_turn = np.bincount(at[~has], minlength=n)
    counts, starts, ends, blocks, no_turn = counts.T.tolist(), starts.tolist(), ends.tolist(), blocks.tolist(), no_turn.tolist()
    for i in range(n):
        s, e = starts[i], ends[i]
        with_turn = s + no_turn[i]
        low, high = (int(turn[with_turn]), int(turn[e - 1])) if with_turn < e else (None, None)
        if blocks[i] <= 1 and 0 < i < n - 1:
            rows, blank_n, duplicate_n, truncated_n, illegal_n, turns = counts[i]
            gaps = 0 if low is None else high - low + 1 - turns
            j = first_block[i]
            found = (short_costs[j], short_audits[j].decode()) if rows else (0, "")
            yield keys[i], None, (keys[i], rows, gaps, blank_n, duplicate_n, truncated_n, illegal_n, *found)
            continue
        if s == e:
            yield keys[i], Span(counts[i], None, None, None, None, None, None, None), None
            continue
        own = cells[:, first_block[i] : first_block[i] + blocks[i]]
        audits = [_audits(line) for line in own]
        costs = (own >> np.uint64(54)).tolist()
        spans = [
            [None if own[c, k] >= _NONE else (costs[c][k], audits[c][k]) for c in range(len(CELLS))]
            for k in range(blocks[i])
        ]
        edge = lambda place: int(turn[place]) if has[place] else None
        yield (
            keys[i],
            Span(counts[i], low, high, int(initial[s]), int(initial[e - 1]), edge(e - 1), edge(s), whole(spans)),
            None,
        )


def _part_row(key: str, part: int, s: Span) -> tuple:
    cells = s.cells or []
    return (
        key, None, None, None, None, None, None, None, None, part, s.counts, s.low, s.high, s.first, s.last,
        s.last_turn, s.first_turn, [c and c[0] for c in cells], [c and c[1].decode() for c in cells],
    )


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parses of the conversations that end inside the task, and spans of the first and
    the last one, of which other tasks may hold rows."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    open_: tuple[str, Span] | None = None
    seen_first = False

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=_PART_NAMES)
        for name in _PART_NAMES:
            if name not in ("_c", "audit", "counts", "costs", "audits"):
                out[name] = pd.array(out[name].tolist(), "Int64")
        return out

    rest = (None,) * (len(_PART_NAMES) - len(_PARSE_NAMES))
    for b in batches:
        rows: list[tuple] = []
        for key, span, row in _batch_spans(b) if len(b) else ():
            if open_ and open_[0] == key:
                open_ = key, open_[1].then(span)
                continue
            if open_:
                rows.append(open_[1].row(open_[0]) + rest if seen_first else _part_row(open_[0], part, open_[1]))
                seen_first, open_ = True, None
            if row:
                rows.append(row + rest)
            else:
                open_ = key, span
        if rows:
            yield frame(rows)
    if open_:
        yield frame([_part_row(open_[0], part, open_[1])])


def _meet(parts: pd.DataFrame) -> pd.DataFrame:
    """Spans of one conversation, a task each, as its parse."""
    total = None
    for r in parts.sort_values("part").itertuples(index=False):
        number = lambda x: None if pd.isna(x) else int(x)
        cells = [
            None if a is None else (int(c), a.encode()) for c, a in zip(r.costs, r.audits, strict=True)
        ] or None
        span = Span(
            [int(x) for x in r.counts], number(r.low), number(r.high), number(r.first), number(r.last),
            number(r.last_turn), number(r.first_turn), cells,
        )
        total = span if total is None else total.then(span)
    return pd.DataFrame([total.row(parts["_c"].iloc[0])], columns=_PARSE_NAMES)


def _key(column: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _id(kind: str) -> Column:
    return F.when(F.col("_c") != "", F.substring("_c", 2, 1 << 30).cast(kind)).alias("conv_id")


#: what orders rows of one turn: role, text
_ORDER = ["_c", "turn", "role", "_head", "_hash"]


def _rows(conversations: DataFrame, copies_column: str | None) -> DataFrame:
    """Rows with their helper columns: nulls in role and text are one space."""
    copies = F.col(copies_column) if copies_column else F.lit(1)
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        _key(F.col("conv_id")).alias("_c"),
        F.col("turn").cast("long").alias("turn"),
        F.when(copies > 0, F.coalesce("role", F.lit(" "))).otherwise("").alias("role"),
        F.when(copies > 0, text).otherwise("").alias("text"),
        copies.cast("long").alias("copies"),
    ).withColumns({"_head": F.substring("text", 1, 32), "_hash": F.xxhash64("text")})


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with damage by crc32("conv_id:turn") % 20, nulls as one space: 0 drops
    a row, 1 empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes its role user.
    ``copies`` is 0, 1 or 2."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(space("text"), "[.!?]", ""))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(space("role")).alias("role"),
        text.otherwise(space("text")).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )


def _parsed(rows: DataFrame) -> DataFrame:
    """A parse per conversation of ``_rows``. No text leaves the map side."""
    keys = ["_c", "turn", "role", "_digest"]
    merged = stored(
        rows.select(
            "_c", "turn", "role", "_head", "_hash", "copies",
            F.unhex(F.sha2("text", 256)).alias("_digest"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")).alias("is_cut"),
        )
        .groupBy(*keys, "_head", "_hash", "blank", "is_cut")
        .agg(F.sum("copies").alias("m")),
        "turn_kinds",
    )
    # rows are now distinct in keys, so neither side of the join has a hot key
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("at"))
    firsts = (
        merged.where("m > 0 AND NOT blank")
        .groupBy(F.col("_c").alias("c"), F.col("role").alias("r"), F.col("_digest").alias("d"))
        .agg(F.min(order).alias("o"))
        .select("*", F.lit(True).alias("hit"))
    )
    here = merged.withColumn("_o", order)
    on = [F.col("_c") == F.col("c"), F.col("role") == F.col("r"), F.col("_digest") == F.col("d"), F.col("_o") == F.col("o")]
    flagged = here.join(firsts, on, "left").select(
        *_ORDER, "_digest", "m", "blank", "is_cut",
        F.coalesce("hit", F.lit(False)).alias("is_first"),
        (F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1).alias("_i"),
    )
    sorted_ = (
        flagged.repartitionByRange(*_ORDER)
        .sortWithinPartitions(*_ORDER, "_digest")
        .select(
            "_c", "m", "blank", "is_cut", "is_first",
            F.when((F.col("_i") < 0) | (F.col("role") == ""), 3).otherwise(F.col("_i")).alias("initial"),
            F.col("turn").isNotNull().alias("has_turn"),
            F.coalesce("turn", F.lit(0)).alias("_turn"),
        )
    )
    spans = stored(sorted_.mapInPandas(_spans, _PART), "spans")
    done = spans.where("counts IS NULL").select(*_PARSE_NAMES)
    met = spans.where("counts IS NOT NULL").groupBy("_c").applyInPandas(_meet, _PARSE)
    return done.unionByName(met)


def parse(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """Cheapest repair of each conversation: conv_id, rows, gaps, blank, duplicate,
    truncated, illegal, cost, audit. The column ``copies``, if named, says how often a row
    stands there, side by side; 0 is a row that is gone.

    Rows are taken by turn, nulls first; rows of one turn by role, then text. Null roles
    and texts are one space, rows of a null conv_id are one conversation, repeated rows
    stand side by side, other columns are ignored, and an empty table gives an empty
    result. A first fault counts per row: blank, duplicate (role and text seen before in
    the conversation), truncated. An audit is one value of the result, of a byte per edit,
    so a conversation has at most about two billion turns."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return _parsed(_rows(conversations, copies)).select(_id(kind), *_PARSE_NAMES[1:])


def _edited(rows: Iterator[tuple], audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from rows in order and their edits."""
    state, at = 0, 0

    def added(role: str) -> str:
        nonlocal state
        role = role or ("assistant" if state == 2 else "user")
        state = STEP[state, role[0]]
        return role

    for role, text in rows:
        while audit[at] == "I":
            yield added(""), ""
            at += 1
        if audit[at] != "D":
            yield added(role if audit[at] == "K" else ""), text
        at += 1
    for _ in audit[at:]:
        yield added(""), ""


def _streams(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Iterator]]:
    """(key, repaired turns) of each conversation; its audit comes before its rows."""

    def flat():
        for b in batches:
            yield from zip(b["_c"], b["audit"], b["role"], b["text"], b["copies"], strict=True)

    rows = flat()
    pending = next(rows, None)

    def turns(key: str) -> Iterator[tuple[str, str]]:
        nonlocal pending
        while (pending := next(rows, None)) is not None and pending[0] == key:
            for _ in range(pending[4]):
                yield pending[2], pending[3]

    while pending is not None:
        key, audit = pending[:2]
        yield key, _edited(turns(key), audit)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for key, turns in _streams(batches):
        digest, between = hashlib.sha256(), b""
        for role, text in turns:
            digest.update(between + f"{role}:{text}".encode())
            between = b"\n"
        out.append((key, digest.hexdigest()))
        if len(out) == 10_000:
            yield pd.DataFrame(out, columns=["_c", "repaired_sha256"])
            out = []
    yield pd.DataFrame(out, columns=["_c", "repaired_sha256"])


def _turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out, held, names = [], 0, ["_c", "place", "role", "text"]
    for key, turns in _streams(batches):
        for place, (role, text) in enumerate(turns):
            out.append((key, place, role, text))
            held += len(text)
            if held > 4_000_000 or len(out) == 10_000:
                yield pd.DataFrame(out, columns=names)
                out, held = [], 0
    yield pd.DataFrame(out, columns=names)


def _with_audits(rows: DataFrame, parses: DataFrame) -> DataFrame:
    """Rows of each conversation in one task, in order, led by its audit. A task reads them
    once and keeps none."""
    nothing = {"turn": "long", "role": "string", "text": "string", "copies": "long", "_head": "string", "_hash": "long"}
    audits = parses.select("_c", "audit", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    both = audits.unionByName(rows.where("copies > 0").withColumn("audit", F.lit(None).cast("string")))
    return (
        both.repartition("_c")
        .sortWithinPartitions("_c", F.col("audit").isNull(), *_ORDER[1:], "text")
        .select("_c", "audit", "role", "text", F.coalesce("copies", F.lit(0)).alias("copies"))
    )


def repaired(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text. Other cases as in
    ``parse``; a conversation of which nothing is left has no rows."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = _rows(conversations, copies)
    turns = _with_audits(rows, _parsed(rows)).mapInPandas(
        _turns, "_c string, place long, role string, text string"
    )
    return turns.select(_id(kind), "place", "role", "text")


def repair_report(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """``parse`` and ``repaired_sha256``, that of the repaired ``role:text`` joined by
    newlines. A digest of one conversation is a chain over its whole text: one task reads
    it as a stream and keeps the state of the digest only."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = _rows(conversations, copies)
    parses = stored(_parsed(rows), "parses")
    digests = _with_audits(rows, parses).mapInPandas(_digests, "_c string, repaired_sha256 string")
    return parses.join(digests, "_c").select(_id(kind), *_PARSE_NAMES[2:], "repaired_sha256")
