"""Gold layer: fact tables and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake import schemas
from velolake.functions.time import calendar_parts, epoch_ms_to_ts, hour_start

FACT_RIDES_COLUMNS = schemas.FACT_RIDES.fieldNames()
FACT_TELEMETRY_COLUMNS = schemas.FACT_TELEMETRY.fieldNames()


def with_event_ts(silver: DataFrame) -> DataFrame:
    """Add ``event_ts`` (whole seconds) from the epoch-ms ``timestamp``; drop rows without one."""
    return silver.withColumn("event_ts", epoch_ms_to_ts("timestamp")).filter(F.col("event_ts").isNotNull())


def epoch_rejects(silver: DataFrame) -> DataFrame:
    """Valid rows whose epoch lies outside the timestamp range: the facts leave them out, and
    nothing else reports them."""
    lost = F.col("timestamp").isNotNull() & epoch_ms_to_ts("timestamp").isNull()
    return silver.agg(F.count_if(lost).alias("epoch_rejects"), F.count(F.lit(1)).alias("valid_rows"))


def fact_rides(silver_rides: DataFrame) -> DataFrame:
    return with_event_ts(silver_rides).select(*FACT_RIDES_COLUMNS)


def fact_telemetry(silver_telemetry: DataFrame) -> DataFrame:
    return with_event_ts(silver_telemetry).select(*FACT_TELEMETRY_COLUMNS)


def with_event_date(facts: DataFrame) -> DataFrame:
    """Add ``event_date`` (UTC day of ``event_ts``), the partition column of date-partitioned
    fact tables: reads limited to a time range then skip whole days of files."""
    return facts.withColumn("event_date", F.to_date("event_ts"))


def dim_values(facts: DataFrame, key: str) -> DataFrame:
    """Batch dimension: the distinct non-NULL values of ``key``.

    Planned as a partial + final aggregate, so a value carried by a third of all rows
    leaves each map task as a single row.  Values are not case-folded.
    """
    return facts.select(key).filter(F.col(key).isNotNull()).distinct()


def dim_payment_method(fact_rides_df: DataFrame) -> DataFrame:
    return dim_values(fact_rides_df, "payment_method")


def dim_city(fact_rides_df: DataFrame) -> DataFrame:
    return dim_values(fact_rides_df, "city")


def event_hours(*facts: DataFrame) -> DataFrame:
    """``hour_start`` of every event of the given fact tables (bag union by name)."""
    times = None
    for f in facts:
        t = f.select("event_ts")
        times = t if times is None else times.unionByName(t)
    return times.select(hour_start("event_ts").alias("hour_start"))


def with_calendar(hours: DataFrame) -> DataFrame:
    return hours.select("hour_start", *calendar_parts("hour_start"))


def dim_time_hourly(fact_rides_df: DataFrame, fact_telemetry_df: DataFrame) -> DataFrame:
    """One row per observed hour with its calendar parts.

    One ``distinct`` over the union: its partial aggregate runs on every task of both
    inputs, so the single shuffle carries at most one row per hour per task."""
    return with_calendar(event_hours(fact_rides_df, fact_telemetry_df).distinct())
