"""Ride and telemetry messages derived from the driver's ``events`` table.

Deterministic arithmetic on ``event_id``, ``ts``, ``event_type`` and ``value`` spreads
rows across valid, failing and undecided verdicts for every rule.  The modulo terms pick
field *values*; every event becomes exactly one ride and one telemetry message, and no
row is filtered out.  The same
expressions are written in SQL by the oracle (``velolake.plans.oracle``).  NULL
fields are left out of the JSON and parse back to NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.session import per_context

# City names of the derived rides; two differ in case only, as cities are not case-folded.
CITIES = ["Aarhus", "Bergen", "bergen", "Cork", "Dresden", "Esbjerg", "Fes", "Graz", "Hull", "Izmir"]

# --- fixed values: test-payload domains that fall outside the allowed sets ---------
PAYMENT_CYCLE = ["card", "wallet", "cash", "crypto"]
STATUS_CYCLE = ["available", "in_use", "charging", "maintenance", "lost"]


def _pick(items: list[str], idx: Column) -> Column:
    """``items[idx]`` (0-based) as a literal array lookup."""
    return F.element_at(F.array(*[F.lit(x) for x in items]), (idx + F.lit(1)).cast("int"))


def _arrival() -> Column:
    # Driver tables store wall-clock UTC as TIMESTAMP_NTZ; read it as an instant.
    return F.col("ts").cast("timestamp")


def _scooter() -> Column:
    return F.concat(F.lit("S-"), (F.lit(100) + F.col("event_id") % 900).cast("string"))


def _epoch_ms() -> Column:
    return F.unix_millis(_arrival())


def ride_payload(extra: dict[str, Column] | None = None) -> Column:
    """The ride message as a struct over ``events`` columns; ``extra`` adds fields to it."""
    et = F.col("event_type")
    eid = F.col("event_id")
    return F.struct(
        F.when(eid % 101 != 7, F.concat(F.lit("R-"), eid.cast("string"))).alias("ride_id"),
        F.when(eid % 103 != 5, F.col("user_id")).alias("user_id"),
        F.when(eid % 107 != 3, _scooter()).alias("scooter_id"),
        (F.when(et.isin("purchase", "click"), F.lit("end"))
          .when(et == "view", F.lit("start"))
          .when(et == "error", F.lit("error"))).alias("event_type"),
        F.when(eid % 109 != 2, _epoch_ms()).alias("timestamp"),
        (eid % 200).alias("duration_mins"),
        F.col("value").alias("distance_km"),
        (F.col("value") - F.lit(1.0)).alias("fare_amount"),
        F.when(eid % 17 != 0, _pick(CITIES, eid % 10)).alias("city"),
        _pick(PAYMENT_CYCLE, eid % 4).alias("payment_method"),
        (F.when(eid % 113 == 1, F.lit("paused"))
          .when(et == "view", F.lit("in_progress"))
          .when(et == "purchase", F.lit("completed"))
          .when(et == "click", F.lit("cancelled"))).alias("ride_status"),
        *[c.alias(k) for k, c in (extra or {}).items()],
    )


def telemetry_payload() -> Column:
    """The telemetry message as a struct over ``events`` columns."""
    eid = F.col("event_id")
    v = F.col("value")
    return F.struct(
        F.when(eid % 101 != 3, _scooter()).alias("scooter_id"),
        F.when(eid % 13 != 0, eid % 121 - 10).alias("battery_level"),
        (v - F.lit(90)).alias("latitude"),
        (F.lit(180) - v).alias("longitude"),
        F.when(eid % 103 != 4, _epoch_ms()).alias("timestamp"),
        (v / F.lit(8)).alias("speed_kmh"),
        (v * F.lit(10) - F.lit(5)).alias("odometer_km"),
        (v - F.lit(20)).alias("temperature_c"),
        (eid % 7).alias("signal_strength"),
        (eid % 2 == 0).alias("is_locked"),
        _pick(STATUS_CYCLE, eid % 5).alias("scooter_status"),
    )


def _envelopes(extra: dict[str, Column] | None = None) -> dict[str, list[Column]]:
    eid = F.col("event_id")
    ride, telemetry = F.to_json(ride_payload(extra)), F.to_json(telemetry_payload())
    # some rides carry text where a number belongs, some messages are no JSON at all
    mistyped = F.regexp_replace(ride, '"duration_mins":[0-9]+', '"duration_mins":"long"')
    text = {"rides": F.when(eid % 131 == 6, mistyped).otherwise(ride), "telemetry": telemetry}
    return {kind: [F.when(eid % 127 == 9, F.lit("{broken")).otherwise(json).cast("binary").alias("value"),
                   _arrival().alias("timestamp")] for kind, json in text.items()}


_plain_envelopes = per_context(_envelopes)


def messages(events: DataFrame, kind: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Kafka-shaped envelope ``(value BINARY, timestamp TIMESTAMP)`` for one topic; ``extra``
    fields are sent with the rides."""
    return events.select(*(_envelopes(extra) if extra else _plain_envelopes())[kind])
