import time

from velolake import schemas
from velolake.sources import sample
from velolake.sources.tables import file_inventory, read_table
from velolake.streaming import layers as L
from velolake.streaming.lake import TOPICS, Lake
from velolake.streaming.sinks import run_layer


def test_missing_table_reads_empty_with_schema(spark):
    lake = Lake.fresh(spark, "t-empty")
    df = lake.read(spark, "mart", "mart_revenue_hourly")
    assert df.count() == 0 and df.schema == schemas.MART_REVENUE
    assert read_table(spark, lake.root + "/nothing", schemas.BRONZE).columns == ["raw_json", "kafka_timestamp"]


def test_continuous_bronze_ingest_and_wait_any(spark):
    from velolake.plans.frames import Frames
    f = Frames(spark, "/root/testdata/sf0.001")
    lake = Lake.fresh(spark, "t-cont")
    L.publish(sample.messages(f.events, "rides"), lake, TOPICS["rides"])
    L.publish(sample.messages(f.events, "telemetry"), lake, TOPICS["telemetry"])
    qs = L.start_bronze(spark, lake, trigger="continuous")
    for q in qs:
        q.processAllAvailable()
    assert all(q.isActive for q in qs)                 # continuous queries keep running
    qs[0].stop()
    t0 = time.time()
    run_layer(qs, wait="any", timeout_s=60)   # returns once one has stopped
    assert time.time() - t0 < 60 and not any(q.isActive for q in qs)
    bronze = lake.read(spark, "bronze", TOPICS["rides"])
    assert bronze.columns == ["raw_json", "kafka_timestamp"] and bronze.count() == 1000
    inv = file_inventory(bronze).first()
    assert inv.files >= 1 and inv.latest_file_time is not None


def test_schema_merge_on_read(spark):
    lake = Lake.fresh(spark, "t-merge")
    path = lake.table("silver", "ride_events")
    spark.createDataFrame([("R-1", 1)], "ride_id string, user_id long").write.mode("append").parquet(path)
    spark.createDataFrame([("R-2", 2, "gps")], "ride_id string, user_id long, source string") \
        .write.mode("append").parquet(path)
    merged = lake.read(spark, "silver", "ride_events", merge_schema=True)
    assert set(merged.columns) == {"ride_id", "user_id", "source"}
    assert {(r.ride_id, r.source) for r in merged.collect()} == {("R-1", None), ("R-2", "gps")}


def test_json_lines_folder_as_topic(spark):
    from velolake.operators import silver
    from velolake.sources.envelope import read_json_lines
    from velolake.streaming.sinks import append_sink
    lake = Lake.fresh(spark, "t-jsonl")
    folder = lake.root + "/incoming"
    spark.createDataFrame([('{"ride_id": "R-1", "user_id": 3, "scooter_id": "S-1", "event_type": "end", '
                            '"timestamp": 1711425045123}',), ("garbage",)], "value string") \
        .coalesce(1).write.text(folder)
    q = append_sink(read_json_lines(spark, folder), lake.table("bronze", "ride_events"),
                    lake.checkpoint("bronze", "ride_events"))
    run_layer([q])
    bronze = lake.read(spark, "bronze", "ride_events")
    assert bronze.count() == 2 and bronze.filter("kafka_timestamp IS NULL").count() == 0
    valid, bad = silver.split(silver.validate_rides(silver.parse_rides(bronze)))
    assert [r.ride_id for r in valid.collect()] == ["R-1"] and bad.count() == 1


def test_folder_inventory_counts_parquet_files_without_reading_them(spark):
    from velolake.sources.tables import folder_inventory
    lake = Lake.fresh(spark, "t-folder")
    path = lake.table("mart", "mart_revenue_hourly")
    empty = folder_inventory(spark, path).first()
    assert (empty.files, empty.latest_file_label) == (0, "No files")
    spark.range(10).repartition(3).write.parquet(path)
    inv = folder_inventory(spark, path).first()
    assert inv.files == 3 and inv.latest_file_label != "No files"
