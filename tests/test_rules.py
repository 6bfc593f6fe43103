"""Rule truth tables: one row per boundary of every rule (NULL, min-e, min, max, max+e, NaN)."""

import pytest

from velolake import constants as K
from velolake import schemas
from velolake.operators import silver

NAN = float("nan")

GOOD_TEL = dict(battery_level=75, is_locked=False, latitude=40.7, longitude=-74.0, odometer_km=892.4,
                scooter_id="S-123", scooter_status="in_use", signal_strength=4, speed_kmh=18.5,
                temperature_c=29.1, timestamp=1711425045123)
GOOD_RIDE = dict(city="paris", distance_km=2.7, duration_mins=14, event_type="start", fare_amount=4.53,
                 payment_method="card", ride_id="R-1", ride_status="in_progress", scooter_id="S-456",
                 timestamp=1711425045123, user_id=523)

V, F_, U = True, False, None   # verdicts: valid, failed, undecided

TEL_CASES = [
    # field, value, verdict, message
    ("scooter_id", None, F_, K.TELEMETRY_MESSAGES[0]),
    ("battery_level", None, U, ""),
    ("battery_level", -1, F_, K.TELEMETRY_MESSAGES[1]),
    ("battery_level", 0, V, None),
    ("battery_level", 100, V, None),
    ("battery_level", 101, F_, K.TELEMETRY_MESSAGES[1]),
    ("latitude", None, U, ""),
    ("latitude", -90.0001, F_, K.TELEMETRY_MESSAGES[2]),
    ("latitude", -90.0, V, None),
    ("latitude", 90.0, V, None),
    ("latitude", 90.0001, F_, K.TELEMETRY_MESSAGES[2]),
    ("latitude", NAN, F_, K.TELEMETRY_MESSAGES[2]),
    ("longitude", None, U, ""),
    ("longitude", -180.0001, F_, K.TELEMETRY_MESSAGES[3]),
    ("longitude", 180.0, V, None),
    ("longitude", 180.0001, F_, K.TELEMETRY_MESSAGES[3]),
    ("timestamp", None, F_, K.TELEMETRY_MESSAGES[4]),
    ("speed_kmh", None, V, None),
    ("speed_kmh", -0.01, F_, K.TELEMETRY_MESSAGES[5]),
    ("speed_kmh", 0.0, V, None),
    ("speed_kmh", 60.0, V, None),
    ("speed_kmh", 60.01, F_, K.TELEMETRY_MESSAGES[5]),
    ("speed_kmh", NAN, F_, K.TELEMETRY_MESSAGES[5]),
    ("odometer_km", None, V, None),
    ("odometer_km", -0.01, F_, K.TELEMETRY_MESSAGES[6]),
    ("odometer_km", 0.0, V, None),
    ("odometer_km", NAN, V, None),            # NaN sorts above every number: >= 0 holds
    ("temperature_c", None, V, None),
    ("temperature_c", -20.01, F_, K.TELEMETRY_MESSAGES[7]),
    ("temperature_c", -20.0, V, None),
    ("temperature_c", 70.0, V, None),
    ("temperature_c", 70.01, F_, K.TELEMETRY_MESSAGES[7]),
    ("signal_strength", None, V, None),
    ("signal_strength", 0, F_, K.TELEMETRY_MESSAGES[8]),
    ("signal_strength", 1, V, None),
    ("signal_strength", 5, V, None),
    ("signal_strength", 6, F_, K.TELEMETRY_MESSAGES[8]),
    ("scooter_status", None, V, None),
    ("scooter_status", "lost", F_, K.TELEMETRY_MESSAGES[9]),
    ("scooter_status", "charging", V, None),
]

RIDE_CASES = [
    ("ride_id", None, F_, K.RIDE_MESSAGES[0]),
    ("user_id", None, F_, K.RIDE_MESSAGES[1]),
    ("user_id", 0, F_, K.RIDE_MESSAGES[2]),
    ("user_id", 1, V, None),
    ("scooter_id", None, F_, K.RIDE_MESSAGES[3]),
    ("event_type", None, U, ""),
    ("event_type", "error", F_, K.RIDE_MESSAGES[4]),
    ("event_type", "end", V, None),
    ("timestamp", None, F_, K.RIDE_MESSAGES[5]),
    ("duration_mins", None, V, None),
    ("duration_mins", -1, F_, K.RIDE_MESSAGES[6]),
    ("duration_mins", 0, V, None),
    ("duration_mins", 180, V, None),
    ("duration_mins", 181, F_, K.RIDE_MESSAGES[6]),
    ("distance_km", -0.01, F_, K.RIDE_MESSAGES[7]),
    ("distance_km", 100.0, V, None),
    ("distance_km", 100.01, F_, K.RIDE_MESSAGES[7]),
    ("distance_km", NAN, F_, K.RIDE_MESSAGES[7]),
    ("fare_amount", None, V, None),
    ("fare_amount", -0.01, F_, K.RIDE_MESSAGES[8]),
    ("fare_amount", 0.0, V, None),
    ("fare_amount", NAN, V, None),
    ("fare_amount", float("inf"), V, None),
    ("payment_method", "crypto", F_, K.RIDE_MESSAGES[9]),
    ("payment_method", "cash", V, None),
    ("payment_method", None, V, None),
    ("ride_status", "lost", F_, K.RIDE_MESSAGES[10]),
    ("ride_status", "cancelled", V, None),
]


def _frame(spark, base, schema, cases):
    rows = []
    for field, value, _, _ in cases:
        r = dict(base)
        r[field] = value
        rows.append(tuple(r[f.name] for f in schema.fields))
    return spark.createDataFrame(rows, schema)


def _check(result, cases):
    assert len(result) == len(cases)
    for (field, value, verdict, msg), row in zip(cases, result):
        assert row.is_valid == verdict, (field, value, row)
        if verdict is False:
            assert row.error_message == msg, (field, value, row.error_message)
        else:
            assert row.error_message is None, (field, value, row.error_message)


def test_telemetry_truth_table(spark):
    df = _frame(spark, GOOD_TEL, schemas.TELEMETRY_PAYLOAD, TEL_CASES)
    _check(silver.validate_telemetry(df).collect(), TEL_CASES)


def test_ride_truth_table(spark):
    df = _frame(spark, GOOD_RIDE, schemas.RIDE_PAYLOAD, RIDE_CASES)
    _check(silver.validate_rides(df).collect(), RIDE_CASES)


def test_multiple_failures_in_rule_order(spark):
    r = dict(GOOD_TEL, scooter_id=None, battery_level=101, speed_kmh=99.0, scooter_status="lost")
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.TELEMETRY_PAYLOAD.fields)],
                               schemas.TELEMETRY_PAYLOAD)
    row = silver.validate_telemetry(df).first()
    assert row.is_valid is False
    assert row.error_message == "|".join([K.TELEMETRY_MESSAGES[i] for i in (0, 1, 5, 9)])


def test_undecided_row_fails_when_another_rule_fails(spark):
    r = dict(GOOD_TEL, battery_level=None, scooter_id=None)
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.TELEMETRY_PAYLOAD.fields)],
                               schemas.TELEMETRY_PAYLOAD)
    row = silver.validate_telemetry(df).first()
    assert row.is_valid is False and row.error_message == K.TELEMETRY_MESSAGES[0]


@pytest.mark.parametrize("mode", ["drop", "quarantine"])
def test_split_routes_cover_input(spark, mode):
    df = _frame(spark, GOOD_TEL, schemas.TELEMETRY_PAYLOAD, TEL_CASES)
    validated = silver.validate_telemetry(df)
    valid, bad = silver.split(validated, silver.telemetry_rules(), undecided=mode)
    n_valid = sum(1 for c in TEL_CASES if c[2] is True)
    n_bad = sum(1 for c in TEL_CASES if c[2] is False)
    n_und = sum(1 for c in TEL_CASES if c[2] is None)
    assert valid.count() == n_valid
    assert "is_valid" not in valid.columns and "error_message" not in valid.columns
    assert "error_message" in bad.columns
    if mode == "drop":
        assert bad.count() == n_bad                       # undecided rows land nowhere
    else:
        assert bad.count() == n_bad + n_und
        msgs = {r.error_message for r in bad.filter("battery_level IS NULL").collect()}
        assert msgs == {"battery_level is null"}
    assert silver.undecided_rows(validated).count() == n_und


def test_reason_counts(spark):
    df = _frame(spark, GOOD_TEL, schemas.TELEMETRY_PAYLOAD, TEL_CASES)
    bad = silver.quarantine_rows(silver.validate_telemetry(df))
    got = {r.reason: r.rows for r in silver.reason_counts(bad).collect()}
    want = {}
    for _, _, verdict, msg in TEL_CASES:
        if verdict is False:
            want[msg] = want.get(msg, 0) + 1
    assert got == want
