"""Ledgers of batches: progress by a listener, late rows before any aggregate."""

import datetime as dt

import pytest

from velolake import schemas
from velolake.operators import marts
from velolake.streaming import layers as L
from velolake.streaming import ledger as G
from velolake.streaming.lake import Lake
from velolake.streaming.sinks import rows_dropped_by_watermark

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def append(spark, lake, seconds):
    rows = [(f"r{s}-{i}", at(s), at(s), 1, "S-1", "end", "completed", "paris", "card", 2.0, 5, 10.0) for i, s in enumerate(seconds)]
    spark.createDataFrame(rows, schemas.FACT_RIDES).coalesce(1).write.mode("append").parquet(lake.table("gold", "fact_rides"))


def count_late(spark, lake):
    rides = marts.revenue_base(lake.read_stream(spark, "gold", "fact_rides", 1))
    L.run_layer([G.start_late_ledger(rides, lake.table("ledger", "late"), lake.checkpoint("ledger", "late"), "1 minute")])


def late(spark, lake):
    return [(r.batch_id, r.rows, r.late_rows, r.watermark) for r in G.read_late(spark, lake.table("ledger", "late")).orderBy("batch_id").collect()]


@pytest.fixture
def lake(spark):
    lake = Lake.fresh(spark, "t-ledger")
    spark.createDataFrame([], schemas.FACT_TELEMETRY).write.parquet(lake.table("gold", "fact_telemetry"))
    return lake


def test_late_rows_are_counted_one_by_one_and_the_listener_hears_every_batch(spark, lake):
    # the third increment has four rows of two closed windows, and one of an open window
    increments = [[10, 120], [160], [65, 30, 31, 32, 5], [300]]
    path = lake.table("ledger", "progress")
    with G.ProgressLedger(spark, path, flush=2):
        dropped = 0
        for seconds in increments:
            append(spark, lake, seconds)
            queries = L.start_marts(spark, lake, window="1 minute", watermark="1 minute", exact=False, state_partitions=1)
            L.run_layer(queries)
            dropped += rows_dropped_by_watermark(queries[0])
            count_late(spark, lake)
    assert late(spark, lake) == [(0, 2, 0, None), (1, 1, 0, at(60)), (2, 5, 4, at(100)), (3, 1, 0, at(100))]
    rows = spark.read.parquet(path)
    mart = [r for r in G.batches(rows).where("name is null and state_rows > 0 or dropped_rows > 0").collect()]
    assert sum(r.dropped_rows for r in mart) == dropped == 1  # one group of four late rows
    by_query = {}
    for r in rows.collect():
        by_query.setdefault(r.query_id, []).append(r)
    assert len(by_query) == 3 and sum(r.input_rows for r in max(by_query.values(), key=lambda q: sum(r.input_rows for r in q))) >= 9
    marks = {r.watermark for q in by_query.values() for r in q if r.dropped_rows}
    assert marks == {"2024-01-01T00:01:40.000Z"}  # the watermark of the late rows' batch, as in the other ledger


def test_a_batch_that_runs_again_counts_once(spark, lake):
    append(spark, lake, [10, 120])
    count_late(spark, lake)
    append(spark, lake, [10, 11, 500])
    count_late(spark, lake)
    want = late(spark, lake)
    assert want == [(0, 2, 0, None), (1, 3, 2, at(60))]
    write = G.late_rows_writer(lake.table("ledger", "late"), "1 minute")
    again = spark.createDataFrame([(at(10),), (at(11),), (at(500),), (None,)], "event_ts timestamp")
    write(again, 1)
    assert late(spark, lake) == want


def test_an_empty_batch_keeps_the_largest_event_time(spark, lake):
    write = G.late_rows_writer(lake.table("ledger", "late"), "1 minute")
    df = lambda *s: spark.createDataFrame([(at(x),) for x in s], "event_ts timestamp")
    for k, batch in enumerate([df(), df(300), df(), df(10)]):
        write(batch, k)
    assert late(spark, lake) == [(0, 0, 0, None), (1, 1, 0, None), (2, 0, 0, at(240)), (3, 1, 1, at(240))]
    assert G.read_late(spark, lake.table("ledger", "nothing")).count() == 0
