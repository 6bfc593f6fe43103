"""Ledgers of what streams did, as tables.

:class:`ProgressLedger` appends a row for every batch of every query it hears of: input rows,
watermark, state rows, dropped rows.  A query itself only remembers its last hundred batches.

The dropped rows of a progress report count what reaches a stateful operator, after partial
aggregation, so several late rows of a window are one.  :func:`late_rows_writer` counts the rows
themselves, before any aggregate: one row a batch with the watermark the batch ran under and the
rows whose window it had closed.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from velolake import constants as K
from velolake.functions.time import tumbling
from velolake.sources.tables import is_missing
from velolake.streaming.sinks import batch_sink

PROGRESS = ("query_id string, run_id string, name string, batch_id long, started string, input_rows long, "
            "watermark string, state_rows long, dropped_rows long")
LATE = "rows long, late_rows long, watermark timestamp, max_event_ts timestamp"
FLUSH = 50  # reports that are held before they are written


def progress_row(p) -> tuple:
    """One row of the progress ledger from a query's progress report."""
    states = p.stateOperators or []
    return (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, (p.eventTime or {}).get("watermark"),
            sum(s.numRowsTotal for s in states), sum(s.numRowsDroppedByWatermark for s in states))


class ProgressLedger(StreamingQueryListener):
    """Appends the progress of all queries of the session to the table at ``path``.

    Reports are written ``flush`` at a time, when a query ends, and by :meth:`close`; a driver
    that dies loses those it held.  A batch that a restart runs again reports again, under
    another ``run_id``: :func:`batches` keeps the last report of a batch."""

    def __init__(self, spark: SparkSession, path: str, flush: int = FLUSH):
        self.spark, self.path, self.most = spark, path, flush
        self.held: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.held.append(progress_row(event.progress))
            full = len(self.held) >= self.most
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self.lock:
            if self.held:
                self.spark.createDataFrame(self.held, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
                self.held = []

    def __enter__(self) -> "ProgressLedger":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def close(self) -> None:
        """Hear the reports that are still on their way, write them, and stop listening."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()


def batches(ledger: DataFrame) -> DataFrame:
    """The last report of every batch that had input or moved the watermark."""
    names = [c for c in ledger.columns if c not in ("query_id", "batch_id")]
    last = F.max_by(F.struct(*names), "started").alias("last")
    return ledger.groupBy("query_id", "batch_id").agg(last).select("query_id", "batch_id", "last.*")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The late-row ledger: batch_id, rows, late_rows, watermark, max_event_ts (so far)."""
    schema = f"{LATE}, batch_id long"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        return spark.createDataFrame([], schema)


def late_rows_writer(path: str, window: str = K.MART_WINDOW_DURATION, delay: str = K.MART_WATERMARK):
    """``foreachBatch`` function that counts a batch's rows and late rows by ``event_ts``.

    The watermark of a batch is the largest event time of the batches before it, less the
    delay; a row is late if its window ended by then, as the marts drop it.  Each batch
    overwrites the folder of its own id, so running it again counts nothing twice, and finds the
    largest event time so far in the folder before it, whichever run wrote that."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        highest = F.lit(None).cast("timestamp")
        if batch_id:  # one row; the ids of a checkpoint's batches follow each other
            highest = batch_df.sparkSession.read.schema(LATE).parquet(f"{path}/batch_id={batch_id - 1}").select("max_event_ts").scalar()
        mark = highest - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(tumbling("event_ts", window)["end"] <= mark, F.lit(False))
        counted = batch_df.where("event_ts is not null").select("event_ts", late.alias("late")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late_rows"), F.max("event_ts").alias("newest"))
        counted.select("rows", "late_rows", mark.alias("watermark"), F.greatest("newest", highest).alias("max_event_ts")) \
            .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def start_late_ledger(rows: DataFrame, path: str, checkpoint: str, window: str = K.MART_WINDOW_DURATION,
                      delay: str = K.MART_WATERMARK, trigger: str = "available_now") -> StreamingQuery:
    """Count the late rows of a stream with ``event_ts``, e.g. ``revenue_base`` of a fact stream."""
    return batch_sink(rows.select("event_ts"), late_rows_writer(path, window, delay), checkpoint, trigger)
