"""What the operators have in common: stored intermediate tables, a global numbering,
and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayscout.sources.files import remember, shared_dir


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``."""
    return shared_dir(spark)


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The rows, written once as a table in the shared folder and read from there: the
    lineage ends here, and a lost executor costs no recomputation. The table goes with
    ``dayscout.sources.files.clean_scratch``, which a caller may use once its own result is
    written, and which runs at the end of the application."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    remember(spark, path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(StructType.fromJson(df.schema.jsonValue())).parquet(path)


def numbered(df: DataFrame, keys: Sequence[Column], name: str, partitions: int | None = None):
    """(rows, total): the rows in global order of ``keys`` with their number from 0 in
    ``name``. Rows are dealt by ranges of the keys, numbered within a partition, and
    shifted by the rows of the partitions before; the shifts are one row per partition.
    Keys should end in a unique column, so that no value is too frequent for one task."""
    spark = df.sparkSession
    keys = list(keys)
    if partitions is None:
        dealt = df.repartitionByRange(*keys)
    else:
        dealt = df.repartitionByRange(partitions, *keys)
    held = stored(
        dealt.sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id()), name
    )
    part, place = F.shiftright(name, 33), F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    counts = held.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    before, shifts = 0, []
    for p, n in sorted((r["p"], r["n"]) for r in counts):
        shifts.append((p, before))
        before += n
    table = spark.createDataFrame(shifts, "_p long, _before long")
    out = held.withColumn("_p", part).join(F.broadcast(table), "_p")
    return out.withColumn(name, place + F.col("_before")).drop("_p", "_before"), before


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of the nodes of ``edges`` (a, b): component is the smallest id that
    can be reached. Large-star and small-star steps alternate (Kiveris et al. 2014), so
    the rounds grow with the logarithm of the nodes; every round ends in a stored table.
    A hub's neighbours are never gathered: only minima per node are joined back."""
    spark = edges.sparkSession
    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(0 if now.isEmpty() else max_rounds):
        # large star: link each neighbour above a node to the smallest around the node
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        ).distinct()
        # small star: link the neighbours below a node, and the node, to the smallest
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.col("b").alias("x"), "m")
            .where("x <> m")
            .unionByName(down.select(F.col("a").alias("x"), "m"))
            .select(F.col("x").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        now = stored(small, "edges")
        state = now.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if state == seen:
            break
        seen = state
    else:
        if seen is not None:
            raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
