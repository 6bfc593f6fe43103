"""Gold by one query a topic: same tables, one read of silver, whole after a failure."""

import pytest
from pyspark.sql import functions as F

from velolake import schemas
from velolake.operators import gold
from velolake.plans.frames import Frames
from velolake.sources import sample
from velolake.streaming import dims as D
from velolake.streaming import layers as L
from velolake.streaming.lake import TOPICS, Lake

TABLES = ("fact_rides", "fact_telemetry", "dim_city", "dim_payment_method", "dim_time_hourly")


@pytest.fixture(scope="module")
def events(spark):
    return Frames(spark, "/root/testdata/sf0.001").events


def increment(spark, lake, events, part):
    for kind, topic in TOPICS.items():
        L.publish(sample.messages(events.where(part), kind), lake, topic)
    L.run_incremental(spark, lake, layers=("bronze", "silver"))


def tables(spark, lake):
    return {t: sorted((tuple(r) for r in L.read_gold(spark, lake, t).collect()), key=str) for t in TABLES}


@pytest.fixture(scope="module")
def plain(spark, events):
    lake = Lake.fresh(spark, "t-five")
    increment(spark, lake, events, F.lit(True))
    L.run_layer(L.start_gold(spark, lake))
    return tables(spark, lake)


def test_tables_equal_those_of_five_queries(spark, events, plain):
    lake = Lake.fresh(spark, "t-two")
    for k in range(3):
        increment(spark, lake, events, F.col("event_id") % 3 == k)
        L.run_layer(L.start_gold_topics(spark, lake))
    L.run_layer(L.start_gold_topics(spark, lake))  # nothing new
    got = tables(spark, lake)
    assert got == plain and len(got["dim_time_hourly"]) == len(set(got["dim_time_hourly"]))
    L.run_layer(L.start_marts(spark, lake, window="1 hour", by_batch=True))
    other = Lake.fresh(spark, "t-marts")
    for t in ("fact_rides", "fact_telemetry"):
        L.read_gold(spark, lake, t).write.parquet(other.table("gold", t))
    L.run_layer(L.start_marts(spark, other, window="1 hour"))
    for t in ("mart_revenue_hourly", "mart_fleet_health_hourly"):
        a, b = (lk.read(spark, "mart", t).drop("total_revenue", "avg_fare_amount", "total_distance_km", "avg_distance_km") for lk in (lake, other))
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_silver_is_read_once(spark, events, monkeypatch):
    lake = Lake.fresh(spark, "t-once")
    increment(spark, lake, events, F.lit(True))
    rows = sum(lake.read(spark, "silver", t).count() for t in TOPICS.values())
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    plain_ts = gold.with_event_ts
    monkeypatch.setattr(gold, "with_event_ts", lambda df: plain_ts(df.mapInArrow(counted, df.schema)))
    L.run_layer(L.start_gold_topics(spark, lake))
    assert read.value == rows > 0


@pytest.mark.parametrize("broken", ["dim_time_hourly", "dim_city"])
def test_a_batch_that_fails_between_two_writes_is_run_again(spark, events, plain, monkeypatch, broken):
    lake = Lake.fresh(spark, "t-fail")
    increment(spark, lake, events, F.col("event_id") % 2 == 0)
    L.run_layer(L.start_gold_topics(spark, lake))
    increment(spark, lake, events, F.col("event_id") % 2 == 1)
    whole = D.merge_writer

    def failing(path, keys, finish=None):
        if broken in path:
            def write(df, batch_id):
                raise RuntimeError("lost between two writes")
            return write
        return whole(path, keys, finish)

    monkeypatch.setattr(D, "merge_writer", failing)
    with pytest.raises(Exception, match="lost between two writes"):
        L.run_layer(L.start_gold_topics(spark, lake))
    monkeypatch.setattr(D, "merge_writer", whole)
    L.run_layer(L.start_gold_topics(spark, lake))
    assert tables(spark, lake) == plain


def test_nothing_to_read(spark):
    lake = Lake.fresh(spark, "t-none")
    spark.createDataFrame([], schemas.SILVER_RIDES).write.parquet(lake.table("silver", "ride_events"))
    spark.createDataFrame([], schemas.SILVER_TELEMETRY).write.parquet(lake.table("silver", "telemetry"))
    L.run_layer(L.start_gold_topics(spark, lake))
    assert tables(spark, lake) == {t: [] for t in TABLES}
