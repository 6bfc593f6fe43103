"""Stateful dedups: their state as a table, and the salted form for hot keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velolake import schemas
from velolake.streaming import layers as L
from velolake.streaming import state
from velolake.streaming.lake import Lake

DAY = dt.datetime(2024, 1, 20)
HOT = 4000


def append(spark, lake, n, city, day=DAY):
    ms = int(day.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    values = {"city": F.lit(city), "timestamp": F.lit(ms) + F.col("id") * 1000, "ride_id": F.concat(F.lit("R-"), "id"), "event_type": F.lit("end"),
              "payment_method": F.lit("card")}
    spark.range(n, numPartitions=4).select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.SILVER_RIDES]) \
        .write.mode("append").parquet(lake.table("silver", "ride_events"))


@pytest.fixture
def lake(spark):
    lake = Lake.fresh(spark, "t-state")
    spark.createDataFrame([], schemas.SILVER_TELEMETRY).write.parquet(lake.table("silver", "telemetry"))
    return lake


def run(spark, lake, dims, table="dim_city", partitions=8):
    qs = L.start_gold(spark, lake, tables=(table,), dims=dims, state_partitions=partitions)
    L.run_layer(qs)
    return qs[0]


def test_state_rows_show_that_nothing_expires(spark, lake):
    for city, day in (("paris", DAY), ("berlin", DAY - dt.timedelta(days=30)), ("cork", DAY + dt.timedelta(days=30)), ("paris", DAY)):
        append(spark, lake, 3, city, day)
        run(spark, lake, "state", partitions=2)
    checkpoint = lake.checkpoint("gold", "dim_city_state")
    rows = state.dedup_keys(spark, checkpoint, "city").collect()
    assert sorted((r.city, r.state_partitions) for r in rows) == [("berlin", 1), ("cork", 1), ("paris", 1)]
    assert [r.city for r in state.dedup_keys(spark, checkpoint, "city", batch_id=0).collect()] == ["paris"]
    operators = state.state_operators(spark, checkpoint).collect()
    assert [(r.operatorId, r.operatorName, r.numPartitions) for r in operators] == [(0, "dedupe", 2)]
    assert {r.city for r in lake.read(spark, "gold", "dim_city").collect()} == {"paris", "berlin", "cork"}


def test_a_hot_key_is_shared_and_reaches_its_last_task_once_a_salt(spark, lake):
    append(spark, lake, HOT, "paris")
    append(spark, lake, 5, "cork")
    query = run(spark, lake, "salted")
    assert sorted(r.city for r in lake.read(spark, "gold", "dim_city").collect()) == ["cork", "paris"]
    checkpoint = lake.checkpoint("gold", "dim_city_salted")
    names = {r.operatorId: r.operatorName for r in state.state_operators(spark, checkpoint).collect()}
    assert sorted(names) == [0, 1]
    # the step by (key, salt) is the one whose state holds a key several times
    seen = [{r.city: r for r in state.dedup_keys(spark, checkpoint, "city", operator=k).collect()} for k in (0, 1)]
    first = max((0, 1), key=lambda k: seen[k]["paris"].state_partitions)
    assert seen[first]["paris"].state_partitions >= 6 and seen[1 - first]["paris"].state_partitions == 1
    passed_on = state.state_rows(spark, checkpoint, first).groupBy("key.city").count().collect()
    assert {r.city: r["count"] for r in passed_on}["paris"] <= 32 < HOT / 100
    shares = spark.range(HOT).select(F.pmod(F.xxhash64(F.timestamp_seconds(F.lit(1705708800) + F.col("id"))), F.lit(32)).alias("s")).groupBy("s").count()
    assert shares.agg(F.max("count")).first()[0] < HOT / 16  # rows of the key in one (key, salt) group
    assert query.exception() is None


@pytest.mark.parametrize("table", ["dim_city", "dim_payment_method", "dim_time_hourly"])
def test_salted_and_plain_dedup_give_the_same_table(spark, lake, table):
    plain = Lake.fresh(spark, "t-plain")
    spark.createDataFrame([], schemas.SILVER_TELEMETRY).write.parquet(plain.table("silver", "telemetry"))
    for k, (city, day) in enumerate((("paris", DAY), ("berlin", DAY - dt.timedelta(days=11)), (None, DAY), ("paris", DAY))):
        for lk, dims in ((lake, "salted"), (plain, "state")):
            append(spark, lk, 40, city, day)
            run(spark, lk, dims, table, partitions=2)
    a, b = (sorted(map(tuple, lk.read(spark, "gold", table).collect())) for lk in (lake, plain))
    assert a == b and a


def test_an_unknown_kind_is_refused(spark, lake):
    with pytest.raises(ValueError, match="unknown kind"):
        L.start_gold(spark, lake, dims="other")
