"""Writes as state changes: old rows plus a batch give the new rows.

Each function is a plain DataFrame expression; ``dayscout.sources.store`` decides
which files the result replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayscout.schemas import Table


def one_per_key(batch: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key by an explicit order (never by input order)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_replace(
    old: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Insert the batch; on a key conflict the batch row replaces the old row.

    The old side is only anti-joined with the batch's keys: when the batch is small
    Spark broadcasts it by its measured size and the old rows are never shuffled.
    """
    fresh = one_per_key(batch, key, order)
    kept = old.join(fresh.select(*key), list(key), "left_anti")
    return kept.unionByName(fresh.select(*old.columns))


def upsert_partial(
    old: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """Insert the batch; on a conflict only ``columns`` take the batch's values.

    Old rows that the batch does not name are only anti-joined with its keys, as in
    ``upsert_replace``; the others, as many as the batch at most, meet it in a join.
    """
    fresh = one_per_key(batch, key, order)
    keys = list(key)
    kept = old.join(fresh.select(*key), keys, "left_anti")
    known = old.alias("o").join(fresh.alias("b"), keys).select(
        *[F.col(c if c in key else f"{'b' if c in columns else 'o'}.{c}").alias(c) for c in old.columns]
    )
    added = fresh.join(old.select(*key), keys, "left_anti").select(*old.columns)
    return kept.unionByName(known).unionByName(added)


def insert_ignore(
    old: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Insert only the keys that are not there yet."""
    return old.unionByName(new_rows(old, batch, key, order).select(*old.columns))


def new_rows(
    old: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The batch rows that ``insert_ignore`` would append."""
    return one_per_key(batch, key, order).join(old.select(*key), list(key), "left_anti")


def clear_flag(table: DataFrame, flag: str, where: Column) -> DataFrame:
    """Conditional update of a boolean column to false."""
    return table.withColumn(flag, F.when(where, F.lit(False)).otherwise(F.col(flag)))


def retain_since(table: DataFrame, date_column: str, first_kept: Column) -> DataFrame:
    """Rows that survive a retention delete."""
    return table.where(F.col(date_column) >= first_kept)


def cascade_delete(children: DataFrame, parents_left: DataFrame, key: Sequence[str]) -> DataFrame:
    """Children whose parent survived."""
    return children.join(parents_left.select(*key), list(key), "left_semi")


def add_column(table: DataFrame, column: str, default: Column) -> DataFrame:
    """Add a column with a default where it is missing or empty."""
    if column in table.columns:
        return table.withColumn(column, F.coalesce(F.col(column), default))
    return table.withColumn(column, default)


def conform(table: DataFrame, spec: Table) -> DataFrame:
    """Project to the declared columns and types; absent nullable columns become NULL."""
    cols = []
    for f in spec.schema.fields:
        if f.name in table.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.nullable:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"{spec.name}: required column {f.name} is missing")
    return table.select(*cols)


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    return table.groupBy(*key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def null_counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def orphans(children: DataFrame, parents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Children that refer to an unknown parent."""
    return children.join(parents.select(*key), list(key), "left_anti")
