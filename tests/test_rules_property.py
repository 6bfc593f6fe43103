"""Rule sets vs a brute-force Python evaluator of the same Kleene logic, on random rows."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from velolake import constants as K
from velolake import schemas
from velolake.operators import silver


def k_and(values):
    """Three-valued AND (None = unknown)."""
    if any(v is False for v in values):
        return False
    if any(v is None for v in values):
        return None
    return True


def lt(a, b):
    if a is None:
        return None
    if isinstance(a, float) and math.isnan(a):
        return False                 # NaN sorts above every number
    return a < b


def gt(a, b):
    if a is None:
        return None
    if isinstance(a, float) and math.isnan(a):
        return True
    return a > b


def between(x, lo, hi):
    a, b = lt(x, lo), gt(x, hi)
    if a is None:
        return None
    return not a and not b


def member(x, allowed):
    return None if x is None else x in allowed


def opt(x, ok):
    return True if x is None else ok


def expected_telemetry(r):
    checks = [
        (r["scooter_id"] is not None, r["scooter_id"] is None),
        (between(r["battery_level"], 0, 100), None if r["battery_level"] is None else not between(r["battery_level"], 0, 100)),
        (between(r["latitude"], -90, 90), None if r["latitude"] is None else not between(r["latitude"], -90, 90)),
        (between(r["longitude"], -180, 180), None if r["longitude"] is None else not between(r["longitude"], -180, 180)),
        (r["timestamp"] is not None, r["timestamp"] is None),
        (opt(r["speed_kmh"], between(r["speed_kmh"], 0, 60)), r["speed_kmh"] is not None and not between(r["speed_kmh"], 0, 60)),
        (opt(r["odometer_km"], not lt(r["odometer_km"], 0)), r["odometer_km"] is not None and lt(r["odometer_km"], 0)),
        (opt(r["temperature_c"], between(r["temperature_c"], -20, 70)), r["temperature_c"] is not None and not between(r["temperature_c"], -20, 70)),
        (opt(r["signal_strength"], between(r["signal_strength"], 1, 5)), r["signal_strength"] is not None and not between(r["signal_strength"], 1, 5)),
        (opt(r["scooter_status"], member(r["scooter_status"], K.ALLOWED_SCOOTER_STATUS)),
         r["scooter_status"] is not None and not member(r["scooter_status"], K.ALLOWED_SCOOTER_STATUS)),
    ]
    verdict = k_and([c[0] for c in checks])
    msg = "|".join(m for (_, fail), m in zip(checks, K.TELEMETRY_MESSAGES) if fail is True)
    return verdict, (msg if verdict is False else None)


def expected_ride(r):
    uid = r["user_id"]
    et = r["event_type"]
    checks = [
        (r["ride_id"] is not None, r["ride_id"] is None),
        (uid is not None, uid is None),
        (None if uid is None else uid > 0, None if uid is None else uid <= 0),
        (r["scooter_id"] is not None, r["scooter_id"] is None),
        (member(et, K.ALLOWED_EVENT_TYPES), None if et is None else et not in K.ALLOWED_EVENT_TYPES),
        (r["timestamp"] is not None, r["timestamp"] is None),
        (opt(r["duration_mins"], between(r["duration_mins"], 0, 180)),
         r["duration_mins"] is not None and not between(r["duration_mins"], 0, 180)),
        (opt(r["distance_km"], between(r["distance_km"], 0, 100)),
         r["distance_km"] is not None and not between(r["distance_km"], 0, 100)),
        (opt(r["fare_amount"], not lt(r["fare_amount"], 0)), r["fare_amount"] is not None and lt(r["fare_amount"], 0)),
        (opt(r["payment_method"], member(r["payment_method"], K.ALLOWED_PAYMENT_METHODS)),
         r["payment_method"] is not None and not member(r["payment_method"], K.ALLOWED_PAYMENT_METHODS)),
        (opt(r["ride_status"], member(r["ride_status"], K.ALLOWED_RIDE_STATUS)),
         r["ride_status"] is not None and not member(r["ride_status"], K.ALLOWED_RIDE_STATUS)),
    ]
    verdict = k_and([c[0] for c in checks])
    msg = "|".join(m for (_, fail), m in zip(checks, K.RIDE_MESSAGES) if fail is True)
    return verdict, (msg if verdict is False else None)


def maybe(s):
    return st.one_of(st.none(), s)


def reals(lo, hi):
    lo, hi = float(lo), float(hi)
    return maybe(st.one_of(st.sampled_from([lo, hi, lo - 0.01, hi + 0.01, float("nan"), float("inf")]),
                           st.floats(lo - 50, hi + 50, allow_nan=False)))


def ints(lo, hi):
    return maybe(st.one_of(st.sampled_from([lo, hi, lo - 1, hi + 1]), st.integers(lo - 20, hi + 20)))


TEL_ROW = st.fixed_dictionaries({
    "battery_level": ints(0, 100), "is_locked": maybe(st.booleans()), "latitude": reals(-90, 90),
    "longitude": reals(-180, 180), "odometer_km": reals(0, 10), "scooter_id": maybe(st.just("S-1")),
    "scooter_status": maybe(st.sampled_from(K.ALLOWED_SCOOTER_STATUS + ["lost"])),
    "signal_strength": ints(1, 5), "speed_kmh": reals(0, 60), "temperature_c": reals(-20, 70),
    "timestamp": maybe(st.just(1711425045123)),
})

RIDE_ROW = st.fixed_dictionaries({
    "city": maybe(st.just("paris")), "distance_km": reals(0, 100), "duration_mins": ints(0, 180),
    "event_type": maybe(st.sampled_from(["start", "end", "error"])), "fare_amount": reals(0, 10),
    "payment_method": maybe(st.sampled_from(K.ALLOWED_PAYMENT_METHODS + ["crypto"])),
    "ride_id": maybe(st.just("R-1")), "ride_status": maybe(st.sampled_from(K.ALLOWED_RIDE_STATUS + ["lost"])),
    "scooter_id": maybe(st.just("S-1")), "timestamp": maybe(st.just(1711425045123)), "user_id": ints(1, 5),
})

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def _run(spark, rows, schema, validate, expect):
    df = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    got = validate(df).select("is_valid", "error_message").collect()
    for r, g in zip(rows, got):
        assert (g.is_valid, g.error_message) == expect(r), r


@SETTINGS
@given(st.lists(TEL_ROW, min_size=50, max_size=200))
def test_telemetry_rules_match_brute_force(spark, rows):
    _run(spark, rows, schemas.TELEMETRY_PAYLOAD, silver.validate_telemetry, expected_telemetry)


@SETTINGS
@given(st.lists(RIDE_ROW, min_size=50, max_size=200))
def test_ride_rules_match_brute_force(spark, rows):
    _run(spark, rows, schemas.RIDE_PAYLOAD, silver.validate_rides, expected_ride)
