"""Pinned schemas for every layer.

The payload schemas are what ``schema_of_json`` infers from a message of each topic
(fields sorted by name, integers as BIGINT, reals as DOUBLE).  They are pinned as
``StructType`` so streaming sources, empty-table fallbacks and tests all share one
definition; ``tests/test_schemas.py`` checks that they equal the inferred ones.
"""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    BinaryType,
    DateType,
)


def _struct(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Kafka-style message envelope (bronze input).
ENVELOPE = _struct(("value", BinaryType()), ("timestamp", TimestampType()))

# Bronze table.
BRONZE = _struct(("raw_json", StringType()), ("kafka_timestamp", TimestampType()))

RIDE_PAYLOAD = _struct(
    ("city", StringType()),
    ("distance_km", DoubleType()),
    ("duration_mins", LongType()),
    ("event_type", StringType()),
    ("fare_amount", DoubleType()),
    ("payment_method", StringType()),
    ("ride_id", StringType()),
    ("ride_status", StringType()),
    ("scooter_id", StringType()),
    ("timestamp", LongType()),
    ("user_id", LongType()),
)

TELEMETRY_PAYLOAD = _struct(
    ("battery_level", LongType()),
    ("is_locked", BooleanType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("odometer_km", DoubleType()),
    ("scooter_id", StringType()),
    ("scooter_status", StringType()),
    ("signal_strength", LongType()),
    ("speed_kmh", DoubleType()),
    ("temperature_c", DoubleType()),
    ("timestamp", LongType()),
)

_INGEST = [StructField("bronze_ingestion_time", TimestampType(), True)]
_ERR = [StructField("error_message", StringType(), True)]

QUARANTINE_ERROR = _ERR
SILVER_RIDES = StructType(_INGEST + RIDE_PAYLOAD.fields)
SILVER_TELEMETRY = StructType(_INGEST + TELEMETRY_PAYLOAD.fields)
QUARANTINE_RIDES = StructType(SILVER_RIDES.fields + _ERR)
QUARANTINE_TELEMETRY = StructType(SILVER_TELEMETRY.fields + _ERR)

FACT_RIDES = _struct(
    ("ride_id", StringType()),
    ("event_ts", TimestampType()),
    ("bronze_ingestion_time", TimestampType()),
    ("user_id", LongType()),
    ("scooter_id", StringType()),
    ("event_type", StringType()),
    ("ride_status", StringType()),
    ("city", StringType()),
    ("payment_method", StringType()),
    ("distance_km", DoubleType()),
    ("duration_mins", LongType()),
    ("fare_amount", DoubleType()),
)

FACT_TELEMETRY = _struct(
    ("event_ts", TimestampType()),
    ("bronze_ingestion_time", TimestampType()),
    ("scooter_id", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("battery_level", LongType()),
    ("speed_kmh", DoubleType()),
    ("odometer_km", DoubleType()),
    ("temperature_c", DoubleType()),
    ("signal_strength", LongType()),
    ("is_locked", BooleanType()),
    ("scooter_status", StringType()),
)

# Facts stored partitioned by event date (``partitionBy("event_date")``).
DATE = [StructField("event_date", DateType(), True)]
FACT_RIDES_BY_DATE = StructType(FACT_RIDES.fields + DATE)
FACT_TELEMETRY_BY_DATE = StructType(FACT_TELEMETRY.fields + DATE)
# Facts that a foreachBatch query writes, a folder a batch.
BATCH = [StructField("batch_id", LongType(), True)]

DIM_PAYMENT_METHOD = _struct(("payment_method", StringType()))
DIM_CITY = _struct(("city", StringType()))
DIM_TIME_HOURLY = _struct(
    ("hour_start", TimestampType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("day_of_week", IntegerType()),
    ("hour", IntegerType()),
)

MART_REVENUE = _struct(
    ("hour_start", TimestampType()),
    ("hour_end", TimestampType()),
    ("completed_rides", LongType()),
    ("total_revenue", DoubleType()),
    ("avg_fare_amount", DoubleType()),
    ("total_distance_km", DoubleType()),
    ("avg_distance_km", DoubleType()),
    ("avg_duration_mins", DoubleType()),
)

MART_FLEET = _struct(
    ("hour_start", TimestampType()),
    ("hour_end", TimestampType()),
    ("fleet_size_seen", LongType()),
    ("avg_battery_level", DoubleType()),
    ("low_battery_scooters", LongType()),
    ("scooters_in_use", LongType()),
    ("scooters_in_maintenance", LongType()),
)


def _sketch_mart(counts, sums):
    return _struct(("hour_start", TimestampType()), ("hour_end", TimestampType()),
                   *[(f"{c}_sketch", BinaryType()) for c in counts],
                   *[x for c, t in sums for x in ((f"sum_{c}", t), (f"count_{c}", LongType()))])


# Marts that keep distinct counts as sketches (velolake.operators.sketches).
SKETCH_REVENUE = _sketch_mart(["completed_rides"], [("fare_amount", DoubleType()), ("distance_km", DoubleType()),
                                                    ("duration_mins", LongType())])
SKETCH_FLEET = _sketch_mart(["fleet_size_seen", "low_battery_scooters", "scooters_in_use", "scooters_in_maintenance"],
                            [("battery_level", LongType())])

# The stored silver table of a topic: both routes, in folders of their own.
ROUTE = StructField("route", StringType(), True)

# Table name -> schema, used for empty-table fallbacks and streaming sources.
TABLE_SCHEMAS = {
    "bronze/ride_events": BRONZE,
    "bronze/telemetry": BRONZE,
    "silver/ride_events": SILVER_RIDES,
    "silver/telemetry": SILVER_TELEMETRY,
    "silver_bad_data/ride_events": QUARANTINE_RIDES,
    "silver_bad_data/telemetry": QUARANTINE_TELEMETRY,
    "gold/fact_rides": FACT_RIDES,
    "gold/fact_telemetry": FACT_TELEMETRY,
    "gold/dim_payment_method": DIM_PAYMENT_METHOD,
    "gold/dim_city": DIM_CITY,
    "gold/dim_time_hourly": DIM_TIME_HOURLY,
    "mart/mart_revenue_hourly": MART_REVENUE,
    "mart/mart_fleet_health_hourly": MART_FLEET,
    "mart/mart_revenue_sketch": SKETCH_REVENUE,
    "mart/mart_fleet_sketch": SKETCH_FLEET,
}
