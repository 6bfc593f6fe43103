"""Batch scans of lake tables and of the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_missing(exc: AnalysisException) -> bool:
    """True for a path that does not exist or holds no data file; any other error is real."""
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               merge_schema: bool = False, columns: StructType | None = None) -> DataFrame:
    """Snapshot of a lake table.  A Parquet streaming sink's folder is read through its
    ``_spark_metadata`` log, so only committed files are seen.  A missing or empty
    table gives an empty frame of ``schema`` when one is given, and is an error otherwise.
    ``columns`` are read from every file, NULL where a file has none of a name; without them
    they are those of some file, or with ``merge_schema`` of all.
    """
    reader = spark.read if columns is None else spark.read.schema(columns)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if schema is None or not is_missing(exc):
            raise
        return spark.createDataFrame([], schema)


def read_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of every ``*.parquet`` file in ``path``, whether a sink's log lists it or not; an
    empty frame when there is none."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/*.parquet")
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        return spark.createDataFrame([], schema)


def file_inventory(table: DataFrame) -> DataFrame:
    """Number of data files holding rows, and the newest file's modification time."""
    return table.select(
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
        F.max(F.col("_metadata.file_modification_time")).alias("latest_file_time"),
    )


def folder_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Every ``*.parquet`` file directly in ``path`` (committed or not, empty or not), as a
    plain folder listing sees them: count, newest modification time, and that time as
    ``yyyy-MM-dd HH:mm:ss`` text or ``"No files"``.  File contents are never read."""
    try:
        # A pattern, not the folder: a folder with a sink's log is listed by that log only.
        files = spark.read.format("binaryFile").load(f"{path}/*.parquet").select("path", "modificationTime")
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        files = spark.createDataFrame([], "path string, modificationTime timestamp")
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.max("modificationTime").alias("latest_file_time")) \
        .withColumn("latest_file_label",
                    F.coalesce(F.date_format("latest_file_time", "yyyy-MM-dd HH:mm:ss"), F.lit("No files")))
