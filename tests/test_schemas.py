from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velolake import schemas


RIDE_MESSAGE = """{"ride_status": "completed", "payment_method": "cash", "city": "Rome", "fare_amount": 3.25,
    "distance_km": 1.5, "duration_mins": 9, "timestamp": 1700000000001, "event_type": "end", "scooter_id": "S-7",
    "user_id": 12, "ride_id": "R-1"}"""
TELEMETRY_MESSAGE = """{"scooter_status": "charging", "is_locked": true, "signal_strength": 2, "temperature_c": 11.5,
    "odometer_km": 120.25, "speed_kmh": 0.5, "timestamp": 1700000000002, "longitude": 9.25, "latitude": 45.5,
    "battery_level": 31, "scooter_id": "S-7"}"""


def _inferred(spark, text):
    ddl = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
    return StructType.fromDDL(ddl)


def test_payload_schemas_equal_inference_from_examples(spark):
    ride = _inferred(spark, RIDE_MESSAGE)
    tel = _inferred(spark, TELEMETRY_MESSAGE)
    assert [(f.name, f.dataType) for f in ride.fields] == \
        [(f.name, f.dataType) for f in schemas.RIDE_PAYLOAD.fields]
    assert [(f.name, f.dataType) for f in tel.fields] == \
        [(f.name, f.dataType) for f in schemas.TELEMETRY_PAYLOAD.fields]


def test_silver_column_order():
    assert schemas.SILVER_RIDES.fieldNames()[0] == "bronze_ingestion_time"
    assert schemas.QUARANTINE_TELEMETRY.fieldNames()[-1] == "error_message"
    assert len(schemas.FACT_RIDES.fields) == 12 and len(schemas.FACT_TELEMETRY.fields) == 12
