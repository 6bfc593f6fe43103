"""Append sinks (S4, S5) and the layer runner."""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from velolake.session import scoped_conf


def _check_trigger(trigger: str) -> None:
    if trigger not in ("available_now", "continuous"):
        raise ValueError(f"trigger must be 'available_now' or 'continuous', got {trigger!r}")


def append_sink(df: DataFrame, path: str, checkpoint: str, trigger: str = "available_now",
                interval: str | None = None, name: str | None = None,
                state_partitions: int | None = None, partition_by: list[str] | None = None) -> StreamingQuery:
    """Start an append-mode Parquet sink with its own checkpoint.

    * ``available_now`` - process everything available (in as many micro-batches as the
      source limits allow), then stop; the next start resumes from the checkpoint (S5).
    * ``continuous`` - default micro-batch trigger: the next batch starts when the last
      ends, or every ``interval`` if given (S4).

    The Parquet sink commits each batch in ``_spark_metadata`` under its batch id, so a
    batch re-run after a failure does not duplicate rows; readers see only committed files.

    ``partition_by`` lays files out in ``column=value`` folders (e.g. facts by day).
    ``state_partitions`` sets the number of state-store partitions of a stateful query
    at its first run (later runs keep the checkpoint's number).  Each partition commits
    its state every batch, so size it to the cluster's cores rather than inheriting a
    batch-oriented ``spark.sql.shuffle.partitions``.
    """
    _check_trigger(trigger)
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    # A stream copies the session conf when it starts, so the scope only needs to cover start().
    with scoped_conf(df.sparkSession, "spark.sql.shuffle.partitions", state_partitions):
        return w.start(path)


def batch_sink(df: DataFrame, fn, checkpoint: str, trigger: str = "available_now",
               name: str | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query; ``fn(batch_df, batch_id)`` must be idempotent per id."""
    _check_trigger(trigger)
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    return w.start()


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late input rows a stateful query discarded (their window had already closed),
    summed over the progress reports the query still holds."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))


def run_layer(queries: list[StreamingQuery], wait: str = "all", timeout_s: float | None = None,
              poll_s: float = 0.2) -> None:
    """Wait for a layer's queries: ``all`` (incremental layers) or ``any`` (continuous
    ingest: return as soon as one of *these* stops, or after ``timeout_s``, then stop the
    others).  A failed query raises its exception, after the layer's others were stopped; they
    resume where they were.  ``all`` raises ``TimeoutError`` if a query
    still runs after ``timeout_s``, as the next layer would read an incomplete table."""
    if wait not in ("all", "any"):
        raise ValueError("wait must be 'all' or 'any'")
    end = None if timeout_s is None else time.monotonic() + timeout_s
    if wait == "all":
        try:
            for q in queries:
                if end is None:
                    q.awaitTermination()
                elif not q.awaitTermination(max(0.001, end - time.monotonic())):
                    raise TimeoutError(f"query {q.name or q.id} still runs after {timeout_s} s")
                if q.exception():
                    raise q.exception()
        except StreamingQueryException:
            for q in queries:  # so that a next run of the layer finds none of them active
                q.stop()
            raise
        return
    while queries and all(q.isActive for q in queries) and (end is None or time.monotonic() < end):
        time.sleep(poll_s)
    for q in queries:
        if q.isActive:
            q.stop()
    for q in queries:
        if q.exception():
            raise q.exception()
