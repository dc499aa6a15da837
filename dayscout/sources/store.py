"""Parquet tables with versions, written aside and published by one rename.

A version is a small JSON file that names, for each table, the file with the list of its
data files. Data files are never changed: a write adds files and publishes a version in
which they take the place of others. So a reader that has resolved a version sees all of
it, whatever is written beside, a job that is lost before its rename leaves the tables as
they were, and a transaction over several tables shows all of them or none.

Files are sorted by the partition column and key and hold a range of them, whose ends
stand in the list: writes find the files they touch there, reads prune by Parquet
statistics inside. How much a file holds follows from the data, not from the calendar.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayscout.operators.writes import new_rows, one_per_key, upsert_partial, upsert_replace
from dayscout.schemas import Table
from dayscout.sources.files import Files, shared_dir

__all__ = ["ConflictError", "ConstraintError", "Snapshot", "Store", "Transaction", "shared_dir"]


class ConflictError(RuntimeError):
    """Another writer has published a table that this transaction read or wrote."""


class ConstraintError(ValueError):
    """Rows that a table does not accept; nothing of the transaction is published."""


@dataclass(frozen=True)
class DataFile:
    """One Parquet file: its path below the table, the ends of its partition column, and
    how many of the table's columns it has."""

    path: str
    rows: int
    bytes: int
    low: str | None
    high: str | None
    columns: int

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]


@dataclass(frozen=True)
class State:
    """A table in one version. ``columns`` are {name, type, default}, in the order they
    were added; a file that has only the first of them reads the rest as their defaults."""

    columns: tuple[dict, ...] = ()
    files: tuple[DataFile, ...] = ()

    def schema(self, n: int) -> StructType:
        return StructType.fromDDL(", ".join(f"`{c['name']}` {c['type']}" for c in self.columns[:n]))

    def with_columns(self, table: Table) -> State:
        known = {c["name"] for c in self.columns}
        new = [
            {"name": f.name, "type": f.dataType.simpleString(), "default": None}
            for f in table.schema.fields
            if f.name not in known
        ]
        return replace(self, columns=(*self.columns, *new)) if new else self

    def dumps(self) -> str:
        return json.dumps({"columns": list(self.columns), "files": [asdict(f) for f in self.files]})

    @classmethod
    def loads(cls, text: str) -> State:
        raw = json.loads(text)
        return cls(tuple(raw["columns"]), tuple(DataFile(**f) for f in raw["files"]))


class Snapshot:
    """The tables of one version."""

    def __init__(self, store: Store, version: int, tables: Mapping[str, str]):
        self.store, self.version, self.tables = store, version, dict(tables)
        self._states: dict[str, State] = {}

    def state(self, table: Table) -> State:
        if table.name not in self._states:
            listed = self.tables.get(table.name)
            text = self.store.files.read(f"{self.store.root}/{listed}") if listed else None
            self._states[table.name] = State.loads(text) if text else State()
        return self._states[table.name]

    def exists(self, table: Table) -> bool:
        return table.name in self.tables or table.name in self._states

    def read(self, table: Table, files: Iterable[DataFile] | None = None, *more: Column) -> DataFrame:
        """The declared columns of the table, or of some of its files; an empty frame where
        nothing was written. A column that a file has from before reads as its default."""
        state = self.state(table)
        chosen = state.files if files is None else tuple(files)
        names = [*table.columns, *(c.alias(f"_more{i}") for i, c in enumerate(more))]
        out = None
        for n in sorted({f.columns for f in chosen}):
            paths = [f"{self.store.path(table)}/{f.path}" for f in chosen if f.columns == n]
            rows = self.store.spark.read.schema(state.schema(n)).parquet(*paths)
            later = {c["name"]: F.lit(c["default"]).cast(c["type"]) for c in state.columns[n:]}
            absent = {f.name: F.lit(None).cast(f.dataType) for f in table.schema.fields if f.name not in rows.columns}
            part = rows.withColumns(absent | later).select(*names)
            out = part if out is None else out.unionByName(part)
        if out is None:
            empty = self.store.spark.createDataFrame([], table.schema)
            out = empty.select(*table.columns, *[F.lit("").alias(f"_more{i}") for i in range(len(more))])
        return out

    def between(self, table: Table, low: object = None, high: object = None) -> list[DataFile]:
        """Files that may hold partition values from low to high (both inclusive)."""
        low, high = (None if v is None else str(v) for v in (low, high))
        return [
            f
            for f in self.state(table).files
            if f.low is None or ((low is None or f.high >= low) and (high is None or f.low <= high))
        ]

    def read_range(self, table: Table, low: object = None, high: object = None) -> DataFrame:
        """The rows with partition values from low to high; other files are not opened."""
        at, rows = F.col(table.partition), self.read(table, self.between(table, low, high))
        if low is not None:
            rows = rows.where(at >= F.lit(low))
        return rows if high is None else rows.where(at <= F.lit(high))


_NAME = "_metadata.file_name"


class Transaction(Snapshot):
    """Writes over a snapshot, seen by its own reads at once and by others when it is
    published as a whole."""

    def __init__(self, store: Store, base: Snapshot):
        super().__init__(store, base.version, base.tables)
        self.base = base
        self.changed: set[str] = set()
        self.seen: set[str] = set()

    def state(self, table: Table) -> State:
        self.seen.add(table.name)
        return super().state(table)

    def _set(self, table: Table, state: State) -> None:
        self._states[table.name] = state
        self.changed.add(table.name)

    # -- writing aside -----------------------------------------------------------------

    def _checked(self, rows: DataFrame, table: Table, against: DataFrame | None):
        """(rows with one flag per rule, the rules): a null where none may be, a key that
        repeats in the rows or is among ``against``, a parent that is not there."""
        flags: dict[str, Column] = {f"null {c}": F.col(c).isNull() for c in table.not_null}
        if against is not None and table.unique:
            keys = list(table.key)
            known = against.select(*keys, F.lit(True).alias("_known"))
            rows = rows.withColumn("_repeats", F.count("*").over(Window.partitionBy(*keys)) > 1)
            rows = rows.join(known, keys, "left")
            flags["repeated key"] = F.col("_repeats") | F.col("_known").isNotNull()
        for columns, parent in table.parents:
            there = self.read(parent).select(
                *[F.col(c).alias(f"_p{i}") for i, c in enumerate(parent.key)], F.lit(True).alias("_there")
            )
            on = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(columns)]
            rows = rows.join(there, on, "left").withColumnRenamed("_there", f"_has_{parent.name}")
            some = F.lit(True)
            for c in columns:
                some &= F.col(c).isNotNull()
            flags[f"unknown {parent.name}"] = some & F.col(f"_has_{parent.name}").isNull()
        return rows, flags

    def _aside(self, rows: DataFrame, table: Table, against: DataFrame | None = None) -> list[DataFile]:
        """Write rows to files of their own. The rules are counted by the write itself."""
        state = self.state(table).with_columns(table)
        self._set(table, state)
        have = set(rows.columns)
        rows, flags = self._checked(rows, table, against)
        columns = [
            (F.col(c["name"]) if c["name"] in have else F.lit(c["default"])).cast(c["type"]).alias(c["name"])
            for c in state.columns
        ]
        order = list(dict.fromkeys([*([table.partition] if table.partition else []), *table.key]))
        found = Observation()
        folder = f"data/{uuid.uuid4().hex}"
        names = {rule: f"_f{i}" for i, rule in enumerate(flags)}
        (
            rows.select(*columns, *[flag.alias(names[rule]) for rule, flag in flags.items()])
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .observe(found, F.count("*").alias("_rows"), *[F.count_if(n).alias(n) for n in names.values()])
            .drop(*names.values())
            .write.parquet(f"{self.store.path(table)}/{folder}")
        )
        broken = [rule for rule, n in names.items() if found.get[n]]
        if broken:
            self.store.files.delete(f"{self.store.path(table)}/{folder}")
            raise ConstraintError(f"{table.name}: {', '.join(broken)}")
        return self._listed(table, folder, len(columns))

    def _listed(self, table: Table, folder: str, columns: int) -> list[DataFile]:
        path = f"{self.store.path(table)}/{folder}"
        sizes = {f.below: f.bytes for f in self.store.files.list(path)}
        at = F.col(table.partition).cast("string") if table.partition else F.lit(None).cast("string")
        ends = (
            self.store.spark.read.schema(table.schema)
            .parquet(path)
            .groupBy(F.col(_NAME).alias("name"))
            .agg(F.count("*").alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))
        )
        return [
            DataFile(f"{folder}/{r['name']}", r["n"], sizes[r["name"]], r["low"], r["high"], columns)
            for r in ends.collect()
        ]

    def _swap(self, table: Table, gone: Iterable[DataFile], new: Iterable[DataFile]) -> None:
        state, out = self.state(table), {f.path for f in gone}
        kept = [f for f in state.files if f.path not in out]
        files = sorted([*kept, *new], key=lambda f: (f.low or "", f.path))
        self._set(table, replace(state, files=tuple(files)))

    # -- the writes --------------------------------------------------------------------

    def append(self, rows: DataFrame, table: Table) -> None:
        """Add rows. A key that repeats, in them or in the table, is refused."""
        span = self.span(rows, table)
        against = self.read(table, self.between(table, *span)).select(*table.key)
        self._swap(table, [], self._aside(rows, table, against))

    def span(self, rows: DataFrame, table: Table) -> tuple:
        if not table.partition:
            return None, None
        at = F.col(table.partition)
        return tuple(rows.agg(F.min(at), F.max(at)).first())

    def holding(self, table: Table, keys: DataFrame, span: tuple = (None, None)) -> list[DataFile]:
        """Files with rows of these keys, by their key columns alone."""
        near = self.between(table, *span)
        if not near:
            return []
        found = self.read(table, near, F.col(_NAME)).select(*table.key, "_more0")
        names = found.join(keys.select(*table.key), list(table.key), "left_semi").select("_more0").distinct()
        hit = {r[0] for r in names.collect()}
        return [f for f in near if f.name in hit]

    def upsert(
        self, batch: DataFrame, table: Table, order: Sequence[Column], newer: str | None = None
    ) -> None:
        """Upsert the first row of each key by ``order``. Only files that hold a key of the
        batch are read in full and written anew. With ``newer``, a batch row whose value
        there is below the stored row's does not replace it."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = one_per_key(_padded(batch, table), table.key, order)
            files = self.holding(table, fresh, self.span(batch, table))
            old = self.read(table, files)
            if newer:
                known = old.select(*table.key, F.col(newer).alias("_stored"))
                late = fresh.join(known, list(table.key)).where(F.col(newer) < F.col("_stored"))
                fresh = fresh.join(late.select(*table.key), list(table.key), "left_anti")
            merged = upsert_replace(old, fresh, table.key, order) if files else fresh
            self._swap(table, files, self._aside(merged.select(*table.columns), table))
        finally:
            batch.unpersist()

    def upsert_columns(
        self, batch: DataFrame, table: Table, columns: Sequence[str], order: Sequence[Column]
    ) -> None:
        """Upsert in which known keys take the batch's values in ``columns`` only."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = _padded(batch, table)
            files = self.holding(table, fresh, self.span(batch, table))
            merged = upsert_partial(self.read(table, files), fresh, table.key, columns, order)
            self._swap(table, files, self._aside(merged, table))
        finally:
            batch.unpersist()

    def insert_ignore(self, batch: DataFrame, table: Table, order: Sequence[Column]) -> None:
        """Add the rows whose key is not there yet; no file is written anew."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            old = self.read(table, self.between(table, *self.span(batch, table)))
            rows = new_rows(old, _padded(batch, table), table.key, order)
            self._swap(table, [], self._aside(rows.select(*table.columns), table))
        finally:
            batch.unpersist()

    def _rewrite(self, table: Table, hit: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Write anew the files named in ``hit``; their number is returned."""
        names = {r[0] for r in hit.select("_more0").distinct().collect()}
        files = [f for f in self.state(table).files if f.name in names]
        if files:
            self._swap(table, files, self._aside(change(self.read(table, files)), table))
        return len(files)

    def update_where(self, table: Table, where: Column, values: Mapping[str, Column]) -> int:
        """Conditional update; files without such a row stay."""
        change = {c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()}
        hit = self.read(table, None, F.col(_NAME)).where(where)
        return self._rewrite(table, hit, lambda old: old.withColumns(change))

    def delete_where(self, table: Table, where: Column) -> int:
        """Delete rows; those for which ``where`` is null stay."""
        hit = self.read(table, None, F.col(_NAME)).where(where)
        return self._rewrite(table, hit, lambda old: old.where(~F.coalesce(where, F.lit(False))))

    def delete_orphans(self, table: Table, parents: DataFrame, key: Sequence[str]) -> int:
        """Delete the rows whose parent is gone; other files stay."""
        left = parents.select(*key)
        hit = self.read(table, None, F.col(_NAME)).join(left, list(key), "left_anti")
        return self._rewrite(table, hit, lambda old: old.join(left, list(key), "left_semi"))

    def replace_all(self, rows: DataFrame, table: Table) -> None:
        """Replace the whole table; ``rows`` may be made from it."""
        new = self._aside(rows, table, self.read(table, ()).select(*table.key))
        self._swap(table, self.state(table).files, new)

    def update(self, table: Table, change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the table by what ``change`` makes of it."""
        self.replace_all(change(self.read(table)), table)

    def drop_before(self, table: Table, first_kept: dt.date) -> int:
        """Retention: rows below ``first_kept`` go, and their number is returned. Files that
        lie below as a whole are dropped from the list unread."""
        if not table.partition:
            raise ValueError(f"{table.name} has no partition column")
        files, bound = self.state(table).files, first_kept.isoformat()
        below = [f for f in files if f.high < bound]
        across = [f for f in files if f.low < bound <= f.high]
        new: list[DataFile] = []
        if across:
            kept = self.read(table, across).where(F.col(table.partition) >= F.lit(first_kept))
            new = self._aside(kept, table)
        self._swap(table, [*below, *across], new)
        return sum(f.rows for f in [*below, *across]) - sum(f.rows for f in new)

    def add_column(self, table: Table, column: str, kind: str, default: object = None) -> None:
        """Add a column without touching a file: rows stored so far have the default, and so
        have later ones whose writer does not know the column. A null written later stays."""
        state = self.state(table)
        if column in {c["name"] for c in state.columns}:
            return
        added = {"name": column, "type": kind, "default": default}
        self._set(table, replace(state, columns=(*state.columns, added)))

    def compact(self, table: Table, small_bytes: int = 64 << 20) -> int:
        """Merge files below ``small_bytes`` into sorted ones of Spark's advisory size; the
        number of files merged is returned."""
        small = [f for f in self.state(table).files if f.bytes < small_bytes]
        if len(small) < 2:
            return 0
        self._swap(table, small, self._aside(self.read(table, small), table))
        return len(small)

    # -- publishing --------------------------------------------------------------------

    def publish(self) -> int:
        """The number of the version that holds the changes."""
        if not self.changed:
            return self.base.version
        store, ours = self.store, {}
        for name in self.changed:
            ours[name] = f"{name}/lists/{uuid.uuid4().hex}.json"
            store.files.write(f"{store.root}/{ours[name]}", self._states[name].dumps())
        base = self.base
        while True:
            text = json.dumps({"tables": base.tables | ours, "changed": sorted(self.changed)})
            if store.files.publish(store.version_path(base.version + 1), text):
                return base.version + 1
            now = store.snapshot()
            moved = {n for n in self.seen | self.changed if now.tables.get(n) != self.base.tables.get(n)}
            if moved:
                raise ConflictError(f"published meanwhile: {', '.join(sorted(moved))}")
            base = now  # others wrote other tables


@dataclass
class Store:
    """Versioned tables under one root folder. Renames in it must not replace files
    silently, as in HDFS and local disks."""

    spark: SparkSession
    root: str
    files: Files = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.files = Files(self.spark)

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def version_path(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def versions(self) -> list[int]:
        names = [f.below for f in self.files.list(f"{self.root}/versions")]
        return sorted(int(n[:12]) for n in names if n.endswith(".json") and n[:12].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or a named one, for reads that belong together."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        elif version and version not in known:
            raise ValueError(f"no version {version}")
        tables = json.loads(self.files.read(self.version_path(version)))["tables"] if version else {}
        return Snapshot(self, version, tables)

    def exists(self, table: Table) -> bool:
        return self.snapshot().exists(table)

    def read(self, table: Table) -> DataFrame:
        """The table in the newest version, which the frame keeps."""
        return self.snapshot().read(table)

    def read_range(self, table: Table, low: object = None, high: object = None) -> DataFrame:
        return self.snapshot().read_range(table, low, high)

    def transaction(self) -> _Open:
        """``with store.transaction() as t``: published as a whole at the end of the block,
        not at all if it raises."""
        return _Open(self)

    def _one(self, name: str, *args, **kwargs):
        with self.transaction() as t:
            return getattr(t, name)(*args, **kwargs)

    def append(self, rows: DataFrame, table: Table) -> None:
        self._one("append", rows, table)

    def replace_all(self, rows: DataFrame, table: Table) -> None:
        self._one("replace_all", rows, table)

    def upsert(self, batch, table, order, newer=None) -> None:
        self._one("upsert", batch, table, order, newer)

    def upsert_columns(self, batch, table, columns, order) -> None:
        self._one("upsert_columns", batch, table, columns, order)

    def insert_ignore(self, batch, table, order) -> None:
        self._one("insert_ignore", batch, table, order)

    def update(self, table, change) -> None:
        self._one("update", table, change)

    def update_where(self, table, where, values) -> int:
        return self._one("update_where", table, where, values)

    def delete_where(self, table, where) -> int:
        return self._one("delete_where", table, where)

    def delete_orphans(self, table, parents, key) -> int:
        return self._one("delete_orphans", table, parents, key)

    def drop_before(self, table, first_kept) -> int:
        return self._one("drop_before", table, first_kept)

    def add_column(self, table, column, kind, default=None) -> None:
        self._one("add_column", table, column, kind, default)

    def compact(self, table, small_bytes=64 << 20) -> int:
        return self._one("compact", table, small_bytes)

    def clean(self, older_than: float, now: float | None = None) -> int:
        """Delete versions published more than ``older_than`` seconds ago, but the newest,
        and files of that age that no version left names: those of replaced rows and of
        jobs that never published. The number of files deleted is returned. The age must
        exceed the longest read and the longest transaction."""
        before = (time.time() if now is None else now) - older_than
        newest = {f"{v:012d}.json" for v in self.versions()[-1:]}
        old = [f for f in self.files.list(f"{self.root}/versions") if f.modified < before and f.below not in newest]
        for f in old:
            self.files.delete(f.path)
        used: set[str] = set()
        for version in self.versions():
            used.add(f"versions/{version:012d}.json")
            for name, listed in self.snapshot(version).tables.items():
                if listed not in used:
                    state = State.loads(self.files.read(f"{self.root}/{listed}"))
                    used |= {listed, *(f"{name}/{f.path}" for f in state.files)}
        left = [f for f in self.files.list(self.root, deep=True) if f.modified < before and f.below not in used]
        for f in left:
            self.files.delete(f.path)
        return len(old) + len(left)


class _Open:
    def __init__(self, store: Store):
        self.store = store

    def __enter__(self) -> Transaction:
        self.open = Transaction(self.store, self.store.snapshot())
        return self.open

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.open.publish()


def _padded(batch: DataFrame, table: Table) -> DataFrame:
    """The batch with every declared column (NULL where absent) and its extra columns,
    which the ordering may use."""
    missing = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in table.schema.fields
        if f.name not in batch.columns
    ]
    return batch.select("*", *missing)
