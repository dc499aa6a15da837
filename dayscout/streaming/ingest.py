"""The daily ingest as a stream of payload files.

Each micro-batch is upserted like a daily batch: newer payloads replace older values.
Only the feature dates a batch can change (its dates and the six after) are
recomputed, from the observations those windows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dayscout.operators.timeseries import LONG_DAYS, rolling_features
from dayscout.operators.writes import one_per_key
from dayscout.schemas import FEATURES, OBSERVATIONS
from dayscout.sources.forecast import parse_forecasts
from dayscout.sources.scans import FEATURE_INPUTS
from dayscout.sources.files import shared_dir
from dayscout.sources.store import Store, Transaction

PAYLOAD_FILE_SCHEMA = "city string, payload string, received_at timestamp"


def _newest_first() -> list[Column]:
    return [F.col("fetched_at").desc_nulls_last()]


def payload_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(PAYLOAD_FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )


def parse_batch(payloads: DataFrame) -> DataFrame:
    """Parsed rows of one micro-batch, one per key: the payload received last wins."""
    rows = parse_forecasts(payloads).withColumnRenamed("received_at", "fetched_at")
    return one_per_key(rows, OBSERVATIONS.key, _newest_first())


def refresh_features(tables: Transaction, touched: DataFrame) -> None:
    """Recompute the features of touched (city, date) and the six days after."""
    reach = LONG_DAYS - 1
    affected = touched.select(
        "city",
        F.explode(F.sequence("date", F.date_add("date", reach))).alias("feature_date"),
    ).distinct()
    needed = touched.select(
        "city",
        F.explode(F.sequence(F.date_sub("date", reach), F.date_add("date", reach))).alias("date"),
    ).distinct()
    near = tables.read_range(OBSERVATIONS, *tables.span(needed, OBSERVATIONS))
    obs = near.join(needed, ["city", "date"], "left_semi")
    fresh = rolling_features(obs.select(*FEATURE_INPUTS)).join(
        affected, ["city", "feature_date"], "left_semi"
    )
    tables.upsert(fresh, FEATURES, [F.col("feature_date")])


def apply_batch(store: Store, payloads: DataFrame) -> None:
    """One micro-batch: upsert observations and refresh features, published together.
    Idempotent. A payload received before the stored one never replaces it, in whatever
    order files arrive."""
    batch = parse_batch(payloads).checkpoint()
    if batch.isEmpty():
        return
    with store.transaction() as t:
        t.upsert(batch, OBSERVATIONS, _newest_first(), newer="fetched_at")
        refresh_features(t, batch.select("city", "date"))


def start_ingest(store: Store, payload_path: str, checkpoint: str) -> StreamingQuery:
    """Process all files present, then stop (run again for the next ones)."""
    shared_dir(store.spark)
    return (
        payload_stream(store.spark, payload_path)
        .writeStream.foreachBatch(lambda df, _epoch: apply_batch(store, df))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
