"""Bronze ingest: message envelope -> raw text + arrival time."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import schemas
from velolake.sources.tables import folder_inventory, is_missing


def raw_envelope(messages: DataFrame) -> DataFrame:
    """``value`` (bytes) -> ``raw_json`` text, broker ``timestamp`` -> ``kafka_timestamp``.

    Works on any frame with Kafka's ``value`` / ``timestamp`` columns, batch or stream.
    """
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def read_topic(spark: SparkSession, bootstrap_servers: str, topic: str,
               starting_offsets: str = "latest", fail_on_data_loss: bool = False) -> DataFrame:
    """Subscribe to one topic (needs the Kafka connector on the classpath)."""
    messages = (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers)
                .option("subscribe", topic)
                .option("startingOffsets", starting_offsets)
                .option("failOnDataLoss", str(fail_on_data_loss).lower())
                .load())
    return raw_envelope(messages)


STARTS = ("earliest", "latest")


def first_start(spark: SparkSession, landing: str, mark: str) -> datetime.datetime | None:
    """The newest file time that the landing folder had when a stream first started there, kept
    at ``mark`` from then on; None if it had no file.  File times only are read, no contents."""
    try:
        return spark.read.schema("first_start timestamp").json(mark).first()[0]
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
    newest = folder_inventory(spark, landing).select(F.col("latest_file_time").alias("first_start"))
    newest.coalesce(1).write.option("ignoreNullFields", "false").json(mark)
    return spark.read.schema("first_start timestamp").json(mark).first()[0]


def read_landing(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 starting: str = "earliest", mark: str | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Stream envelope files (``value``, ``timestamp``) dropped into a landing folder.

    The file-based stand-in for a topic: each new file is read once, offsets live in the
    consuming query's checkpoint.  It keeps a topic's rules of start and loss:

    * ``starting="latest"`` leaves out the messages that were there when the stream first started;
      that moment is kept at ``mark``, so that every later start goes on from the checkpoint as
      the first one would have.  ``"earliest"`` reads everything.
    * ``fail_on_data_loss=False`` goes on without a file that goes while its batch runs; otherwise
      the stream fails, as its messages are lost.  A file that has gone before its batch is planned
      is left out either way: Spark's file source does not tell.
    """
    if starting not in STARTS:
        raise ValueError(f"starting must be one of {STARTS}, got {starting!r}")
    if starting == "latest" and mark is None:
        raise ValueError("starting='latest' needs a place to keep the first start")
    reader = spark.readStream.schema(schemas.ENVELOPE).option("ignoreMissingFiles", str(not fail_on_data_loss).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    messages = reader.parquet(path)
    since = first_start(spark, path, mark) if starting == "latest" else None
    if since is not None:  # a condition on the file alone: older files are listed, not read
        messages = messages.where(F.col("_metadata.file_modification_time") > F.lit(since))
    return raw_envelope(messages)


def read_json_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream raw JSON-lines files from a folder as bronze rows: each line is one message,
    and the file's modification time stands in for the broker time."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(
        F.col("value").alias("raw_json"),
        F.col("_metadata.file_modification_time").alias("kafka_timestamp"),
    )
