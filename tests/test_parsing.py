"""Permissive JSON parsing: field-level NULLs, unparseable text -> all-NULL row."""

import math

from pyspark.sql import functions as F

from velolake.operators import silver


def _bronze(spark, texts):
    return spark.createDataFrame([(t, None) for t in texts], "raw_json string, kafka_timestamp timestamp")


def test_parse_edge_cases(spark):
    texts = [
        "plain text",
        None,
        "{}",
        '{"ride_id": "a", "unknown": 1}',
        '{"ride_id": "b", "user_id": "twelve"}',
        '{"ride_id": "c", "user_id": 5.7}',
        '{"ride_id": "d", "user_id": 99999999999999999999999}',
        '{"ride_id": 12}',
        '{"ride_id": "e", "fare_amount": NaN, "distance_km": Infinity}',
        '{"ride_id": "f", "distance_km": 3}',
    ]
    rows = silver.parse_rides(_bronze(spark, texts)).collect()
    assert len(rows) == len(texts)                       # no row disappears
    by = {r.ride_id: r for r in rows if r.ride_id}
    assert all(v is None for v in rows[0].asDict().values())
    assert all(v is None for v in rows[1].asDict().values())
    assert all(v is None for v in rows[2].asDict().values())
    assert by["a"].user_id is None                       # unknown key ignored, missing key NULL
    assert by["b"].user_id is None                       # string in BIGINT -> NULL field only
    assert by["c"].user_id is None                       # fraction in BIGINT
    assert by["d"].user_id is None                       # overflow
    assert "12" in by                                    # number in STRING -> text
    assert math.isnan(by["e"].fare_amount) and math.isinf(by["e"].distance_km)
    assert by["f"].distance_km == 3.0                    # integer widens to DOUBLE


def test_unparseable_row_is_quarantined_with_required_messages(spark):
    v = silver.validate_rides(silver.parse_rides(_bronze(spark, ["not json"])))
    r = v.first()
    assert r.is_valid is False
    assert r.error_message == "ride_id is null|user_id is null|scooter_id is null|timestamp is null"


def test_envelope_projection(spark):
    from velolake.sources.envelope import raw_envelope
    df = spark.createDataFrame([(bytearray(b'{"a":1}'), None)], "value binary, timestamp timestamp")
    out = raw_envelope(df)
    assert out.columns == ["raw_json", "kafka_timestamp"]
    assert out.first().raw_json == '{"a":1}'
    assert out.select(F.col("raw_json")).schema.fields[0].dataType.simpleString() == "string"
