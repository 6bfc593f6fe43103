"""Tables that gain columns while their streams keep their checkpoints."""

import datetime as dt
import json

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from velolake import schemas
from velolake.streaming import layers as L
from velolake.streaming.evolution import SchemaConflict, conform, evolve, merged, stored_schema
from velolake.streaming.lake import TOPICS, Lake

DAY = dt.datetime(2024, 1, 20, 6)
GROWN = StructType([*schemas.RIDE_PAYLOAD, StructField("promo_code", StringType()), StructField("tip", DoubleType())])


def ride(k, **more):
    return {"ride_id": f"R-{k}", "user_id": 1 + k, "scooter_id": "S-1", "event_type": "end", "timestamp": 1705730400000 + 1000 * k,
            "fare_amount": 3.0, "distance_km": 1.0, "duration_mins": 5, "city": "paris", "payment_method": "card",
            "ride_status": "completed", **more}


def publish(spark, lake, rides):
    rows = [(bytearray(json.dumps(r).encode()), DAY) for r in rides]
    L.publish(spark.createDataFrame(rows, schemas.ENVELOPE).coalesce(1), lake, TOPICS["rides"])
    L.publish(spark.createDataFrame([], schemas.ENVELOPE), lake, TOPICS["telemetry"])


def run(spark, lake, payload=None, **gold):
    L.run_layer(L.start_bronze(spark, lake))
    L.run_layer(L.start_silver(spark, lake, payloads={"rides": payload} if payload else None))
    L.run_layer(L.start_gold(spark, lake, tables=("fact_rides", "fact_telemetry", "dim_city"), **gold))


def test_merged_appends_nullable_columns_and_refuses_other_types():
    a = StructType([StructField("x", LongType(), False), StructField("y", StringType())])
    both = merged(a, StructType([StructField("z", DoubleType(), False), StructField("y", StringType())]))
    assert both == StructType([StructField("x", LongType()), StructField("y", StringType()), StructField("z", DoubleType())])
    assert merged(both, StructType([])) == both
    with pytest.raises(SchemaConflict, match="y: string is stored, double is written"):
        merged(a, StructType([StructField("y", DoubleType())]))


def test_a_version_is_kept_only_for_a_change(spark):
    lake = Lake.fresh(spark, "t-versions")
    path = lake.schema_path("gold", "fact_rides")
    base = schemas.FACT_RIDES
    assert stored_schema(spark, path) is None and evolve(spark, path, base, base) == base
    assert stored_schema(spark, path) is None
    one = evolve(spark, path, base, StructType([StructField("tip", DoubleType())]))
    assert evolve(spark, path, base, base) == one == stored_schema(spark, path)
    two = evolve(spark, path, base, StructType([StructField("note", StringType())]))
    assert two.fieldNames() == [*base.fieldNames(), "tip", "note"]
    assert spark.read.json(path).count() == 2
    with pytest.raises(SchemaConflict):
        evolve(spark, path, base, StructType([StructField("tip", StringType())]))
    assert stored_schema(spark, path) == two


def test_conform_orders_columns_and_fills_missing_ones(spark):
    df = spark.createDataFrame([(1, "k", "r")], "b long, a string, route string")
    out = conform(df, StructType([StructField("a", StringType()), StructField("c", DoubleType()), StructField("b", LongType())]))
    assert out.columns == ["a", "c", "b", "route"] and out.first() == ("k", None, 1, "r")


@pytest.mark.parametrize("by_date", [False, True])
def test_new_fields_reach_silver_facts_and_their_readers_from_old_checkpoints(spark, by_date):
    lake = Lake.fresh(spark, "t-grow")
    bad = {"user_id": -1}
    publish(spark, lake, [ride(1), ride(2, promo_code="early"), ride(3, **bad)])
    run(spark, lake, date_partitioned=by_date)                       # the plan does not know the field yet
    publish(spark, lake, [ride(4, promo_code="A", tip=0.5), ride(5), ride(6, promo_code="B", **bad)])
    run(spark, lake, GROWN, date_partitioned=by_date)
    publish(spark, lake, [ride(7, tip=1.5)])
    run(spark, lake, date_partitioned=by_date)                       # started by the old call: the table has the columns
    run(spark, lake, date_partitioned=by_date)                       # nothing new
    want = {("R-1", None, None), ("R-2", None, None), ("R-4", "A", 0.5), ("R-5", None, None), ("R-7", None, 1.5)}
    for layer, table in (("silver", TOPICS["rides"]), ("gold", "fact_rides")):
        df = lake.read(spark, layer, table)
        assert {(r.ride_id, r.promo_code, r.tip) for r in df.collect()} == want and df.count() == 5
        assert df.columns[:12] == schemas.TABLE_SCHEMAS[f"{layer}/{table}"].fieldNames()[:12]
    quarantine = lake.read(spark, "silver_bad_data", TOPICS["rides"])
    assert {(r.ride_id, r.promo_code, r.error_message) for r in quarantine.collect()} == {
        ("R-3", None, "user_id must be > 0"), ("R-6", "B", "user_id must be > 0")}
    assert [r.city for r in L.read_gold(spark, lake, "dim_city").collect()] == ["paris"]
    # a reader that starts now, and the mart
    stream = lake.read_stream(spark, "gold", "fact_rides")
    assert {"promo_code", "tip"} <= set(stream.columns)
    L.run_layer(L.start_marts(spark, lake, date_partitioned=by_date))
    assert lake.read(spark, "mart", "mart_revenue_hourly").columns == schemas.MART_REVENUE.fieldNames()


def test_a_field_of_another_type_stops_the_start(spark):
    lake = Lake.fresh(spark, "t-clash")
    publish(spark, lake, [ride(1)])
    run(spark, lake, GROWN)
    clash = StructType([*schemas.RIDE_PAYLOAD, StructField("tip", StringType())])
    with pytest.raises(SchemaConflict, match="tip"):
        L.start_silver(spark, lake, payloads={"rides": clash})
    run(spark, lake)
    assert lake.read(spark, "gold", "fact_rides").count() == 1
