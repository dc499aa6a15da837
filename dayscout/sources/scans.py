"""Scans over the tables. Each is a filter and a projection, so both reach the files.

``as_of`` is a date literal or a Column; nothing here reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayscout.schemas import ALL_TABLES

When = dt.date | Column

FEATURE_INPUTS = ["city", "date", "temp_mean", "precipitation", "wind_speed_max"]


def day(value: When) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def observations_lookback(obs: DataFrame, as_of: When, days: int = 30) -> DataFrame:
    """Feature inputs of the last ``days`` days. There is no upper bound on purpose:
    forecast days after ``as_of`` are part of the table."""
    return obs.where(F.col("date") >= F.date_sub(day(as_of), days)).select(*FEATURE_INPUTS)


def observations_history(obs: DataFrame) -> DataFrame:
    return obs.select(*FEATURE_INPUTS)


def observations_between(obs: DataFrame, start: When, end: When) -> DataFrame:
    return obs.where(F.col("date").between(day(start), day(end)))


def _usable(features: DataFrame) -> DataFrame:
    return features.where(
        F.col("temp_mean_7d").isNotNull() & F.col("temp_mean_3d").isNotNull()
    )


def features_on(features: DataFrame, as_of: When) -> DataFrame:
    return _usable(features).where(F.col("feature_date") == day(as_of))


def features_window(features: DataFrame, as_of: When, days: int = 90) -> DataFrame:
    return _usable(features).where(F.col("feature_date") >= F.date_sub(day(as_of), days))


def features_all(features: DataFrame) -> DataFrame:
    return _usable(features)


def run_sql(spark: SparkSession, sql: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """A parameterised SELECT. DataFrames are passed by name: ``{obs}`` in the text
    refers to ``obs=...``; ``:name`` refers to a value in ``args``."""
    return spark.sql(sql, args=args or {}, **views)


def describe_columns(spark: SparkSession, name: str, table: DataFrame) -> DataFrame:
    """Column names and types of a table, with how many values are present."""
    present = table.agg(*[F.count(c).alias(c) for c in table.columns])
    columns = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"`{f.name}`").alias("n_present"),
            )
            for i, f in enumerate(table.schema.fields, 1)
        ]
    )
    return present.select(F.inline(columns))


def has_column(table: DataFrame, column: str) -> bool:
    return column in table.columns


def has_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def declared_schema(name: str):
    return {t.name: t.schema for t in ALL_TABLES}[name]
