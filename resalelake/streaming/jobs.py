"""Streaming twins of the daily jobs. What a stream gives does not depend on how its files fall into micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELAY = "2 days"
ARRIVED = "arrived_at"


def follow(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a landing folder, as a stream, with the time each file landed."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def drop_repeats(stream: DataFrame, keys: list[str], arrived: str = ARRIVED, delay: str = DELAY) -> DataFrame:
    """First copy of every key; copies that land within the delay are dropped.

    The watermark follows arrival, and files are taken in the order they landed, so no row is ever late, however
    old the record in it is. State holds the keys of the last ``delay`` of arrivals.
    """
    return stream.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(keys)


def drain(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything that has landed, append the results, stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_each(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Same, with a function per micro-batch. The step must be idempotent: a batch may be replayed."""
    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
