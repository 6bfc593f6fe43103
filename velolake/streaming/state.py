"""The state of a stream as a table (W5, W6): what a stateful operator remembers, read from its
checkpoint by Spark's own state sources, without running the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """(key, value, partition_id) of one stateful operator after its last batch, or ``batch_id``."""
    reader = spark.read.format("statestore").option("operatorId", str(operator))
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    return reader.load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: number, name, partitions, first and last batch kept."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")


def dedup_keys(spark: SparkSession, checkpoint: str, key: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """(key, state_partitions): the keys a stateful dedup has seen, each with the number of state
    partitions that remember it: one, or for the first of two salted steps several."""
    return state_rows(spark, checkpoint, operator, batch_id).groupBy(F.col(f"key.{key}").alias(key)).agg(
        F.count_distinct("partition_id").alias("state_partitions"))
