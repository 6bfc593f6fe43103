"""Multi-run streaming behaviour: watermark emission, late rows, restarts, dedup."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velolake import schemas
from velolake.streaming import layers as L
from velolake.streaming.dims import read_dimension
from velolake.streaming.lake import Lake

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def fact_ride(rid, ts, event_type="end"):
    return (rid, ts, ts, 1, "S-100", event_type, "completed", "paris", "card", 2.0, 5, 10.0)


def append_facts(spark, lake, rows):
    spark.createDataFrame(rows, schemas.FACT_RIDES).coalesce(1).write.mode("append") \
        .parquet(lake.table("gold", "fact_rides"))


def run_marts(spark, lake, exact, dropped=None):
    from velolake.streaming.sinks import rows_dropped_by_watermark, run_layer
    qs = L.start_marts(spark, lake, window="1 minute", watermark="1 minute", exact=exact)
    run_layer(qs)
    if dropped is not None:
        assert rows_dropped_by_watermark(qs[0]) == dropped
    return {(r.hour_start, r.completed_rides) for r in lake.read(spark, "mart", "mart_revenue_hourly").collect()}


@pytest.mark.parametrize("exact", [False, True])
def test_watermark_emission_and_late_rows(spark, exact):
    lake = Lake.fresh(spark, "t-wm")
    spark.createDataFrame([], schemas.FACT_TELEMETRY).write.parquet(lake.table("gold", "fact_telemetry"))
    # step 1: watermark moves to 00:01:00 and closes [00:00, 00:01)
    append_facts(spark, lake, [fact_ride("a", at(10)), fact_ride("b", at(120))])
    assert run_marts(spark, lake, exact) == {(at(0), 1)}
    # step 2: watermark 00:01:40, nothing closes
    append_facts(spark, lake, [fact_ride("c", at(160))])
    assert run_marts(spark, lake, exact) == {(at(0), 1)}
    # step 3: 00:01:05 falls in an open window (kept); 00:00:30 in a closed one (dropped)
    append_facts(spark, lake, [fact_ride("d", at(65)), fact_ride("e", at(30))])
    assert run_marts(spark, lake, exact, dropped=1) == {(at(0), 1)}
    # step 4: watermark 00:04:00 closes [00:01,00:02) and [00:02,00:03)
    append_facts(spark, lake, [fact_ride("f", at(300))])
    assert run_marts(spark, lake, exact) == {(at(0), 1), (at(60), 1), (at(120), 2)}
    # restart with no new data: nothing new, nothing duplicated
    assert run_marts(spark, lake, exact) == {(at(0), 1), (at(60), 1), (at(120), 2)}
    assert lake.read(spark, "mart", "mart_revenue_hourly").count() == 3


def test_only_completed_rides_move_the_revenue_watermark(spark):
    lake = Lake.fresh(spark, "t-wm2")
    spark.createDataFrame([], schemas.FACT_TELEMETRY).write.parquet(lake.table("gold", "fact_telemetry"))
    append_facts(spark, lake, [fact_ride("a", at(10)), fact_ride("s", at(600), event_type="start")])
    assert run_marts(spark, lake, exact=False) == set()   # the start event does not close 00:00


def silver_ride(rid, ts, city, pm="card"):
    ms = int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return (ts, city, 2.0, 5, "end", 10.0, pm, rid, "completed", "S-100", ms, 1)


def append_silver(spark, lake, rows):
    spark.createDataFrame(rows, schemas.SILVER_RIDES).coalesce(1).write.mode("append") \
        .parquet(lake.table("silver", "ride_events"))


def _dim(spark, lake, mode):
    path = lake.table("gold", "dim_city")
    if mode == "merge":
        return sorted(r.city for r in read_dimension(spark, path).collect())
    return sorted(r.city for r in lake.read(spark, "gold", "dim_city").collect())


@pytest.mark.parametrize("mode", ["merge", "state"])
def test_dimension_dedup_across_runs(spark, mode):
    lake = Lake.fresh(spark, f"t-dim-{mode}")
    spark.createDataFrame([], schemas.SILVER_TELEMETRY).write.parquet(lake.table("silver", "telemetry"))
    day = dt.datetime(2024, 1, 20)
    append_silver(spark, lake, [silver_ride("a", day, "paris"), silver_ride("b", day, "Paris"),
                                silver_ride("c", day, "paris"), silver_ride("d", day, None)])
    for _ in range(2):     # the second run has no new data
        L.run_layer(L.start_gold(spark, lake, tables=("dim_city",), dims=mode))
    assert _dim(spark, lake, mode) == ["Paris", "paris"]          # no case folding, NULL dropped
    # a repeated key, and a new key 11 days behind the watermark: still emitted
    append_silver(spark, lake, [silver_ride("e", day, "paris"),
                                silver_ride("f", day - dt.timedelta(days=11), "berlin")])
    L.run_layer(L.start_gold(spark, lake, tables=("dim_city",), dims=mode))
    assert _dim(spark, lake, mode) == ["Paris", "berlin", "paris"]


def test_end_to_end_rerun_adds_nothing(spark):
    from velolake.plans.frames import Frames
    from velolake.sources import sample
    from velolake.streaming.lake import TOPICS
    f = Frames(spark, "/root/testdata/sf0.001")
    lake = Lake.fresh(spark, "t-e2e")
    L.publish(sample.messages(f.events, "rides"), lake, TOPICS["rides"])
    L.publish(sample.messages(f.events, "telemetry"), lake, TOPICS["telemetry"])
    L.run_incremental(spark, lake, window="1 hour", exact=True)
    counts = {(layer, t): lake.read(spark, layer, t).count() for layer, t in
              [("bronze", "ride_events"), ("silver", "ride_events"), ("silver_bad_data", "ride_events"),
               ("gold", "fact_rides"), ("mart", "mart_revenue_hourly"), ("mart", "mart_fleet_health_hourly")]}
    assert counts["silver", "ride_events"] == f.silver_rides.count() > 0   # the batch form's valid rides
    L.run_incremental(spark, lake, window="1 hour", exact=True)
    again = {(layer, t): lake.read(spark, layer, t).count() for layer, t in
             [("bronze", "ride_events"), ("silver", "ride_events"), ("silver_bad_data", "ride_events"),
              ("gold", "fact_rides"), ("mart", "mart_revenue_hourly"), ("mart", "mart_fleet_health_hourly")]}
    assert again == counts


def test_mart_stream_on_rocksdb_state_store(spark):
    from velolake.session import ROCKSDB_PROVIDER
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        lake = Lake.fresh(spark, "t-rocks")
        spark.createDataFrame([], schemas.FACT_TELEMETRY).write.parquet(lake.table("gold", "fact_telemetry"))
        append_facts(spark, lake, [fact_ride("a", at(10)), fact_ride("b", at(20)), fact_ride("c", at(200))])
        assert run_marts(spark, lake, exact=True) == {(at(0), 2)}
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def test_date_partitioned_facts_prune_reconciliation(spark):
    from velolake.operators import quality
    from velolake.plans.frames import Frames
    from velolake.sources import sample
    from velolake.streaming.lake import TOPICS
    f = Frames(spark, "/root/testdata/sf0.001")
    lake = Lake.fresh(spark, "t-bydate")
    L.publish(sample.messages(f.events, "rides"), lake, TOPICS["rides"])
    L.publish(sample.messages(f.events, "telemetry"), lake, TOPICS["telemetry"])
    L.run_incremental(spark, lake, window="1 hour", exact=True, date_partitioned=True)
    facts = lake.read(spark, "gold", "fact_rides")
    assert "event_date" in facts.columns and facts.count() == f.fact_rides.count()
    mart = lake.read(spark, "mart", "mart_revenue_hourly")
    assert mart.count() > 0
    recon = quality.revenue_reconciliation(facts, mart)
    plan = recon._jdf.queryExecution().executedPlan().toString()
    pruned = [c for c in plan.split("PartitionFilters: ")[1:] if c.startswith("[isnotnull(event_date")]
    assert pruned and "(event_date" in pruned[0][:300] and ">=" in pruned[0][:300]
    r = recon.first()
    assert r.diff == 0 and r.within_tolerance


def test_one_run_in_bounded_batches_matches_separate_runs(spark):
    """availableNow with maxFilesPerTrigger=1: one micro-batch per file, so the watermark moves
    between files exactly as in four separate runs (same windows, same dropped row)."""
    import time
    from velolake.streaming.sinks import rows_dropped_by_watermark, run_layer
    lake = Lake.fresh(spark, "t-bounded")
    spark.createDataFrame([], schemas.FACT_TELEMETRY).write.parquet(lake.table("gold", "fact_telemetry"))
    for rows in ([fact_ride("a", at(10)), fact_ride("b", at(120))], [fact_ride("c", at(160))],
                 [fact_ride("d", at(65)), fact_ride("e", at(30))], [fact_ride("f", at(300))]):
        append_facts(spark, lake, rows)
        time.sleep(1.1)          # distinct file times keep the arrival order
    qs = L.start_marts(spark, lake, window="1 minute", watermark="1 minute", exact=True, max_files_per_trigger=1)
    run_layer(qs)
    got = {(r.hour_start, r.completed_rides) for r in lake.read(spark, "mart", "mart_revenue_hourly").collect()}
    assert got == {(at(0), 1), (at(60), 1), (at(120), 2)}
    assert rows_dropped_by_watermark(qs[0]) == 1


def test_dimension_folders_stay_bounded(spark, tmp_path):
    from velolake.streaming import dims as D
    path = str(tmp_path / "dim")
    write = D.merge_writer(path, ["city"], compact_after=3)
    for batch in range(20):
        rows = [(f"c{batch // 2}",), ("c0",)]
        write(spark.createDataFrame(rows, "city string"), batch)
        write(spark.createDataFrame(rows, "city string"), batch)  # a batch that is run again
        got = sorted(r.city for r in D.read_dimension(spark, path).collect())
        assert got == sorted({f"c{k // 2}" for k in range(batch + 1)})
    folders = [p for p in (tmp_path / "dim").glob("full=*/batch_id=*")]
    assert len(folders) <= 8 and not (tmp_path / "dim" / "full=0" / "batch_id=19").exists()


def test_files_a_day_do_not_follow_the_tasks(spark):
    lake = Lake.fresh(spark, "t-days")
    rows = spark.range(0, 3000, 1, 12).selectExpr(
        "timestamp_seconds(1700000000 + id * 800) AS event_ts", "cast(id as string) AS ride_id")
    for name in schemas.FACT_RIDES.fieldNames():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(schemas.FACT_RIDES[name].dataType))
    silver = rows.withColumn("timestamp", F.unix_millis("event_ts")).drop("event_ts")
    silver.select(*schemas.SILVER_RIDES.fieldNames()).write.parquet(lake.table("silver", "ride_events"))
    spark.createDataFrame([], schemas.SILVER_TELEMETRY).write.parquet(lake.table("silver", "telemetry"))
    L.run_layer(L.start_gold(spark, lake, tables=("fact_rides",), date_partitioned=True))
    files = spark.read.parquet(lake.table("gold", "fact_rides")).select("event_date", "_metadata.file_path").distinct()
    most = files.groupBy("event_date").count().agg(F.max("count")).first()[0]
    assert most <= L.DAY_FILES


def test_waiting_for_any_looks_at_its_own_queries_only(spark):
    import time
    from velolake.streaming.sinks import run_layer
    old = spark.readStream.format("rate").load().writeStream.format("memory").queryName("old").start()
    old.stop()
    new = spark.readStream.format("rate").load().writeStream.format("memory").queryName("new").start()
    began = time.monotonic()
    run_layer([new], wait="any", timeout_s=1.5)
    assert time.monotonic() - began >= 1.4 and not new.isActive
