"""Marts of sketches: what rolls up equals what was counted directly, within the bound."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velolake import schemas
from velolake.operators import marts, sketches as S
from velolake.streaming import layers as L
from velolake.streaming.lake import Lake

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def telemetry(spark):
    """Three hours; 60,000 scooters in the first, many minutes each, a few in the others."""
    n = 180000
    return spark.range(n, numPartitions=8).select(
        (F.lit(T0) + F.make_interval(secs=F.col("id") % 10800)).cast("timestamp").alias("event_ts"),
        F.when(F.col("id") % 997 != 0, F.concat(F.lit("S-"), F.when(F.col("id") % 10800 < 3600, F.col("id") % 59999).otherwise(F.col("id") % 7))).alias("scooter_id"),
        (F.col("id") % 101).alias("battery_level"),
        F.element_at(F.array(F.lit("in_use"), F.lit("maintenance"), F.lit("charging")), (F.col("id") % 3 + 1).cast("int")).alias("scooter_status"),
    ).cache()


def test_hours_from_minutes_equal_direct_sketches_and_lie_within_the_bound(telemetry):
    minutes = S.fleet_sketch_mart(telemetry, "1 minute")
    assert minutes.count() == 180
    hours = {r.hour_start: r for r in S.estimates(S.rollup(minutes, "1 hour")).collect()}
    direct = {r.hour_start: r for r in S.estimates(S.fleet_sketch_mart(telemetry, "1 hour")).collect()}
    assert hours.keys() == direct.keys() and len(hours) == 3
    exact = {r.hour_start: r for r in marts.fleet_mart(telemetry, "1 hour", exact=True).collect()}
    assert exact[T0].fleet_size_seen > 30000
    for h, row in hours.items():
        for c in S.FLEET_SKETCHES:
            assert row[c] == direct[h][c]
            assert abs(row[c] - exact[h][c]) <= max(3, S.BOUND * exact[h][c])
        assert row.avg_battery_level == pytest.approx(exact[h].avg_battery_level)
    assert hours[T0 + dt.timedelta(hours=1)].fleet_size_seen == 7


def test_rolling_up_twice_changes_nothing(telemetry):
    minutes = S.fleet_sketch_mart(telemetry, "1 minute")
    once, twice = S.rollup(minutes, "1 hour"), S.rollup(S.rollup(minutes, "10 minutes"), "1 hour")
    assert sorted(S.estimates(once).collect()) == sorted(S.estimates(twice).collect())
    assert once.columns == minutes.columns


def test_totals_count_a_scooter_once(telemetry):
    total = S.total_distinct(S.fleet_sketch_mart(telemetry, "1 minute")).first()
    exact = telemetry.agg(F.count_distinct("scooter_id")).first()[0]
    windows = S.estimates(S.fleet_sketch_mart(telemetry, "1 minute")).agg(F.sum("fleet_size_seen")).first()[0]
    assert total.windows == 180 and abs(total.fleet_size_seen - exact) <= S.BOUND * exact
    assert windows > 1.2 * total.fleet_size_seen  # the sum of windows' counts repeats scooters


def test_empty_and_null_keys(spark):
    none = spark.createDataFrame([], schemas.FACT_TELEMETRY)
    assert S.fleet_sketch_mart(none).collect() == []
    total = S.total_distinct(S.fleet_sketch_mart(none)).first()
    assert (total.windows, total.fleet_size_seen) == (0, 0)
    rows = spark.createDataFrame([(T0, None, 5, None), (T0, None, None, "in_use")],
                                 "event_ts timestamp, scooter_id string, battery_level long, scooter_status string")
    row = S.estimates(S.fleet_sketch_mart(rows)).first()
    assert (row.fleet_size_seen, row.scooters_in_use, row.avg_battery_level) == (0, 0, 5.0)


def test_a_stream_keeps_the_sketches_of_closed_windows(spark, telemetry):
    lake = Lake.fresh(spark, "t-sketch")
    facts = telemetry.select(*[F.col(f.name).cast(f.dataType) if f.name in telemetry.columns else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in schemas.FACT_TELEMETRY])
    for k in range(2):  # a window's rows come in two batches
        facts.where(F.unix_timestamp("event_ts") % 2 == k).write.mode("append").parquet(lake.table("gold", "fact_telemetry"))
    spark.createDataFrame([], schemas.FACT_RIDES).write.parquet(lake.table("gold", "fact_rides"))
    L.run_layer(L.start_sketch_marts(spark, lake, max_files_per_trigger=20, state_partitions=2))
    stored = lake.read(spark, "mart", "mart_fleet_sketch")
    assert stored.schema.simpleString() == schemas.SKETCH_FLEET.simpleString() and stored.count() == 178
    batch = S.fleet_sketch_mart(telemetry, "1 minute").where(F.col("hour_end") <= stored.agg(F.max("hour_end")).scalar())
    assert sorted(S.estimates(stored).collect()) == sorted(S.estimates(batch).collect())
