"""Silver layer: parse, apply rule sets, split valid / quarantine (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velolake import constants as K
from velolake import schemas
from velolake.functions import rules as R
from velolake.functions.payload import parse_payload
from velolake.session import per_context

UNDECIDED_MODES = ("drop", "quarantine")


@per_context
def telemetry_rules() -> list[R.Rule]:
    """Telemetry rule set, in message order.  Battery, latitude and longitude are strict:
    a NULL there leaves the verdict undecided rather than failing it."""
    m = K.TELEMETRY_MESSAGES
    return [
        R.not_null("scooter_id", m[0]),
        R.in_range("battery_level", 0, 100, m[1]),
        R.in_range("latitude", -90, 90, m[2]),
        R.in_range("longitude", -180, 180, m[3]),
        R.not_null("timestamp", m[4]),
        R.in_range("speed_kmh", 0, 60, m[5], optional=True),
        R.at_least("odometer_km", 0, m[6], optional=True),
        R.in_range("temperature_c", -20, 70, m[7], optional=True),
        R.in_range("signal_strength", 1, 5, m[8], optional=True),
        R.one_of("scooter_status", K.ALLOWED_SCOOTER_STATUS, m[9], optional=True),
    ]


@per_context
def ride_rules() -> list[R.Rule]:
    """Ride rule set, in message order.  ``event_type`` is strict (NULL: undecided)."""
    m = K.RIDE_MESSAGES
    return [
        R.not_null("ride_id", m[0]),
        R.not_null("user_id", m[1]),
        R.greater_than("user_id", 0, m[2]),
        R.not_null("scooter_id", m[3]),
        R.one_of("event_type", K.ALLOWED_EVENT_TYPES, m[4]),
        R.not_null("timestamp", m[5]),
        R.in_range("duration_mins", 0, 180, m[6], optional=True),
        R.in_range("distance_km", 0, 100, m[7], optional=True),
        R.at_least("fare_amount", 0, m[8], optional=True),
        R.one_of("payment_method", K.ALLOWED_PAYMENT_METHODS, m[9], optional=True),
        R.one_of("ride_status", K.ALLOWED_RIDE_STATUS, m[10], optional=True),
    ]


def parse_rides(bronze: DataFrame, payload: StructType = schemas.RIDE_PAYLOAD) -> DataFrame:
    return parse_payload(bronze, payload)


def parse_telemetry(bronze: DataFrame, payload: StructType = schemas.TELEMETRY_PAYLOAD) -> DataFrame:
    return parse_payload(bronze, payload)


@per_context
def _ride_checks():
    rules = ride_rules()
    return R.verdict(rules), R.error_text(rules)


@per_context
def _telemetry_checks():
    rules = telemetry_rules()
    return R.verdict(rules), R.error_text(rules)


def validate_rides(parsed: DataFrame) -> DataFrame:
    return R.with_checks(parsed, *_ride_checks())


def validate_telemetry(parsed: DataFrame) -> DataFrame:
    return R.with_checks(parsed, *_telemetry_checks())


def apply_rules_to(parsed: DataFrame, rules: list[R.Rule]) -> DataFrame:
    return R.apply_rules(parsed, rules)


def valid_rows(validated: DataFrame) -> DataFrame:
    """Rows whose verdict is TRUE, without the helper columns."""
    return validated.filter(F.col("is_valid") == F.lit(True)).drop("is_valid", "error_message")


def undecided_rows(validated: DataFrame) -> DataFrame:
    """Rows whose verdict is NULL (a strict rule saw NULL and nothing else failed)."""
    return validated.filter(F.col("is_valid").isNull()).drop("is_valid", "error_message")


def _why_undecided(rules: list[R.Rule]):
    return F.concat_ws(K.ERROR_SEPARATOR, *[
        F.when(r.ok.isNull(), F.lit(f"{r.column} is null")) for r in rules
    ])


def quarantine_rows(validated: DataFrame, rules: list[R.Rule] | None = None,
                    undecided: str = "drop") -> DataFrame:
    """Rows to quarantine, keeping ``error_message``.

    ``undecided="drop"`` keeps only FALSE verdicts, so undecided rows land nowhere (the
    reference behaviour).  ``"quarantine"`` also keeps them, with the message
    ``"<column> is null"`` for every strict rule whose operand was NULL; this needs the
    rule list that produced the verdict.
    """
    if undecided not in UNDECIDED_MODES:
        raise ValueError(f"undecided must be one of {UNDECIDED_MODES}")
    if undecided == "drop":
        return validated.filter(F.col("is_valid") == F.lit(False)).drop("is_valid")
    if rules is None:
        raise ValueError("undecided='quarantine' needs the rule list")
    return (validated
            .filter(F.coalesce(F.col("is_valid"), F.lit(False)) == F.lit(False))
            .withColumn("error_message",
                        F.when(F.col("is_valid").isNull(), _why_undecided(rules)).otherwise(F.col("error_message")))
            .drop("is_valid"))


def split(validated: DataFrame, rules: list[R.Rule] | None = None,
          undecided: str = "drop") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) routes of one validated frame."""
    return valid_rows(validated), quarantine_rows(validated, rules, undecided)


VALID, INVALID = "valid", "invalid"


def routed(validated: DataFrame, rules: list[R.Rule] | None = None, undecided: str = "drop") -> DataFrame:
    """Both routes in one frame, told apart by ``route``: a sink partitioned by it needs one
    parse of the input.  ``error_message`` is NULL on the valid route."""
    if undecided not in UNDECIDED_MODES:
        raise ValueError(f"undecided must be one of {UNDECIDED_MODES}")
    ok, message = F.col("is_valid"), F.col("error_message")
    if undecided == "drop":
        validated = validated.filter(ok.isNotNull())
    elif rules is None:
        raise ValueError("undecided='quarantine' needs the rule list")
    else:
        message = F.when(ok.isNull(), _why_undecided(rules)).otherwise(message)
    valid = F.coalesce(ok, F.lit(False))
    return (validated.withColumn("error_message", F.when(~valid, message))
            .withColumn("route", F.when(valid, F.lit(VALID)).otherwise(F.lit(INVALID))).drop("is_valid"))


def reasons(quarantine: DataFrame, source: str | None = None) -> DataFrame:
    """One row per failed rule message of each quarantined row (narrow ``explode``)."""
    r = F.explode(F.split(F.col("error_message"), r"\|")).alias("reason")
    if source is None:
        return quarantine.select(r)
    return quarantine.select(F.lit(source).alias("source"), r)


def reason_counts(quarantine: DataFrame, source: str | None = None) -> DataFrame:
    """Rows per failed rule message over a quarantine table."""
    return count_reasons(reasons(quarantine, source))


def count_reasons(reason_rows: DataFrame) -> DataFrame:
    """Count per (source,) reason.  Partially aggregated before the shuffle, so a message
    carried by most rows costs one partial row per task; several quarantine tables can be
    unioned first and counted in one shuffle."""
    keys = [c for c in ("source", "reason") if c in reason_rows.columns]
    return reason_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
