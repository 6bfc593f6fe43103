"""Incrementally maintained dimensions (G3-G5 in streaming, W5).

``merge`` mode (default) runs each micro-batch as a batch job: the batch's distinct
keys (partial aggregation, so a key carried by a third of the rows leaves every task
as one row), minus the keys already written by *earlier* batches (left anti join),
written to a folder of the batch's own.  Re-running a batch id after a failure
overwrites that folder with the same rows, so the table stays exactly-once; the table
itself is the dedup state and grows with distinct keys only.  The number of folders is
bounded: see :func:`merge_writer`.

``salted`` mode is the same operator in two steps, by (key, salt) and then by key, so a hot key's
rows go to as many tasks as there are salts, and one row a salt to one task.

``state`` mode is the plain ``withWatermark`` + ``dropDuplicates([key])`` operator.
As the key has no event-time column, the watermark never expires state (every key is
kept forever, and late rows still emit new keys); every row of a key is shuffled to
one task each batch.  Kept for parity; ``merge`` gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from velolake import constants as K
from velolake.functions.time import calendar_parts, hour_start
from velolake.sources.tables import is_missing

BATCH_COL = "batch_id"
FULL_COL = "full"        # 1: the folder holds the whole table up to its batch
TOPIC_COL = "topic"      # parts of a dimension that two queries write
COMPACT_AFTER = 16       # folders after which a batch writes the whole table


def _parts(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        return None


def _current(parts: DataFrame, before: int | None = None) -> tuple[DataFrame, int]:
    """The table's rows as of the batches before ``before``, and in how many folders they
    are: the last whole table, and what came after it.  Only folder names are looked at."""
    if before is not None:
        parts = parts.filter(F.col(BATCH_COL) < before)
    folders = parts.select(FULL_COL, BATCH_COL).distinct().collect()  # at most COMPACT_AFTER and some
    base = max((r[BATCH_COL] for r in folders if r[FULL_COL] == 1), default=-1)
    return parts.filter(F.col(BATCH_COL) >= base), sum(r[BATCH_COL] >= base for r in folders)


def _drop_folders(spark, path: str, below: int) -> None:
    """Remove the folders of batches below a whole table that an earlier batch has written."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for flag in (0, 1):
        kind = jvm.org.apache.hadoop.fs.Path(root, f"{FULL_COL}={flag}")
        for status in (fs.listStatus(kind) if fs.exists(kind) else []):
            name = status.getPath().getName()
            if name.startswith(f"{BATCH_COL}=") and int(name.split("=")[1]) < below:
                fs.delete(status.getPath(), True)


def merge_writer(path: str, keys: list[str], finish=None, compact_after: int = COMPACT_AFTER):
    """``foreachBatch`` function appending new distinct ``keys`` to the table at ``path``.
    ``finish`` maps the new keys to the stored columns (e.g. adds calendar parts).

    A batch without new keys writes nothing.  Once ``compact_after`` folders have gathered,
    a batch with new keys writes the whole table, and the batch after that drops the older
    folders: a batch that is run again still finds all it was run on."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        fresh = batch_df.select(*keys).dropna(subset=keys).distinct()
        parts = _parts(spark, path)
        prior, folders = (None, 0) if parts is None else _current(parts, batch_id)
        if prior is not None:
            fresh = fresh.join(prior.select(*keys), on=keys, how="left_anti")
        new = (finish(fresh) if finish else fresh).persist()
        try:
            if new.isEmpty():
                return
            out = new
            full = folders >= compact_after
            if full:
                _drop_folders(spark, path, min(r[0] for r in prior.select(F.min(BATCH_COL)).collect()))
                out = prior.drop(FULL_COL, BATCH_COL).unionByName(new)
            out.write.mode("overwrite").parquet(f"{path}/{FULL_COL}={int(full)}/{BATCH_COL}={batch_id}")
        finally:
            new.unpersist()
    return write


def topic_writer(fact_path: str, facts, dimensions: list[tuple[str, str, Callable | None]]):
    """``foreachBatch`` function of one topic: a batch's facts, and its new keys of every
    dimension, under the batch's id (W8).

    The batch is read once, for ``facts(batch_df)``, which overwrites the batch's own folder of
    the fact table; the keys come from the two or three columns of that folder.  ``dimensions``
    are (path, key, finish) as :func:`merge_writer` takes them.  Every write is idempotent under
    its batch id, so a batch that fails between two of them is simply run again, whole."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        rows = facts(batch_df)
        folder = f"{fact_path}/{BATCH_COL}={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(rows.schema).parquet(folder)
        for path, key, finish in dimensions:
            keys = hours_of(written) if key == "hour_start" else written
            merge_writer(path, [key], finish)(keys.select(key), batch_id)
    return write


def read_dimension(spark, path: str, schema=None) -> DataFrame:
    """Batch read of a dimension of either mode, without the folder columns."""
    parts = _parts(spark, path)
    if parts is None:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    if TOPIC_COL in parts.columns:
        topics = [r[0] for r in parts.select(TOPIC_COL).distinct().collect()]  # one or two
        each = [read_dimension(spark, f"{path}/{TOPIC_COL}={t}") for t in sorted(topics)]
        return reduce(DataFrame.unionByName, each).distinct()
    return _current(parts)[0].drop(FULL_COL, BATCH_COL) if FULL_COL in parts.columns else parts


def dedup_state(stream: DataFrame, key: str, watermark: str = K.DEDUP_WATERMARK) -> DataFrame:
    """The reference form: watermark on ``event_ts``, then ``dropDuplicates([key])``."""
    return (stream.withWatermark("event_ts", watermark)
            .select("event_ts", key)
            .filter(F.col(key).isNotNull())
            .dropDuplicates([key])
            .select(key))


SALTS = 32  # tasks that share a key's rows in ``salted`` mode


def dedup_salted(stream: DataFrame, key: str, watermark: str = K.DEDUP_WATERMARK, salts: int = SALTS) -> DataFrame:
    """:func:`dedup_state` for keys that many rows carry: two chained dedups, the first by key and
    salt.  The salt comes from the event time, so a batch that runs again salts alike; the second
    step gets a key at most ``salts`` times in the life of the checkpoint."""
    return (stream.withWatermark("event_ts", watermark)
            .select("event_ts", key, F.pmod(F.xxhash64("event_ts"), F.lit(salts)).cast("int").alias("salt"))
            .filter(F.col(key).isNotNull())
            .dropDuplicates([key, "salt"])
            .dropDuplicates([key])
            .select(key))


def hours_salted(times: DataFrame, watermark: str = K.DEDUP_WATERMARK, salts: int = SALTS) -> DataFrame:
    """``dim_time_hourly`` by two chained dedups: the current hour has most rows of a batch."""
    return (times.withWatermark("event_ts", watermark)
            .select("event_ts", hour_start("event_ts").alias("hour_start"),
                    F.pmod(F.xxhash64("event_ts"), F.lit(salts)).cast("int").alias("salt"))
            .dropDuplicates(["hour_start", "salt"])
            .dropDuplicates(["hour_start"])
            .select("hour_start", *calendar_parts("hour_start")))


def hours_of(stream: DataFrame) -> DataFrame:
    return stream.select(hour_start("event_ts").alias("hour_start"))


def hours_state(times: DataFrame, watermark: str = K.DEDUP_WATERMARK) -> DataFrame:
    """Reference form of ``dim_time_hourly``: dedup on ``hour_start`` under the watermark."""
    return (times.withWatermark("event_ts", watermark)
            .withColumn("hour_start", hour_start("event_ts"))
            .dropDuplicates(["hour_start"])
            .select("hour_start", *calendar_parts("hour_start")))
