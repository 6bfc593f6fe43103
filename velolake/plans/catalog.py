"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query starts from the driver's ``events`` table and runs the whole pipeline
as one lazy plan (see :class:`velolake.plans.frames.Frames`); timestamps are
returned as ``TIMESTAMP_NTZ`` wall-clock UTC.  Streaming queries are registered in
:mod:`velolake.plans.stream_catalog`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.operators import gold, marts, quality, reports, silver
from velolake import schemas
from velolake.plans.frames import Frames, StoredTables, as_ntz, with_faults

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str, digits: int | None = None):
    """``digits``: see :func:`velolake.plans.frames.as_ntz`."""
    def deco(fn: Callable[[Frames], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_ntz(fn(Frames(spark, sf_dir)), digits)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# --- bronze / silver ---------------------------------------------------------------

@register("bronze_parse_rides")
def bronze_parse_rides(f: Frames):
    """Envelope -> raw_json -> typed ride columns."""
    return f.parsed_rides


@register("bronze_parse_telemetry")
def bronze_parse_telemetry(f: Frames):
    return f.parsed_telemetry


@register("silver_rides_valid")
def silver_rides_valid(f: Frames):
    return f.silver_rides


@register("silver_rides_quarantine")
def silver_rides_quarantine(f: Frames):
    return f.quarantine_rides


@register("silver_rides_undecided")
def silver_rides_undecided(f: Frames):
    return silver.undecided_rows(f.validated_rides)


@register("silver_rides_quarantine_with_undecided")
def silver_rides_quarantine_with_undecided(f: Frames):
    return silver.quarantine_rows(f.validated_rides, silver.ride_rules(), undecided="quarantine")


@register("silver_telemetry_valid")
def silver_telemetry_valid(f: Frames):
    return f.silver_telemetry


@register("silver_telemetry_quarantine")
def silver_telemetry_quarantine(f: Frames):
    return f.quarantine_telemetry


@register("silver_telemetry_undecided")
def silver_telemetry_undecided(f: Frames):
    return silver.undecided_rows(f.validated_telemetry)


@register("silver_telemetry_quarantine_with_undecided")
def silver_telemetry_quarantine_with_undecided(f: Frames):
    return silver.quarantine_rows(f.validated_telemetry, silver.telemetry_rules(), undecided="quarantine")


@register("quarantine_reason_counts")
def quarantine_reason_counts(f: Frames):
    return silver.count_reasons(silver.reasons(f.quarantine_rides, "ride_events")
                                .unionByName(silver.reasons(f.quarantine_telemetry, "telemetry")))


# --- gold ----------------------------------------------------------------------------

@register("fact_rides")
def fact_rides(f: Frames):
    return f.fact_rides


@register("fact_telemetry")
def fact_telemetry(f: Frames):
    return f.fact_telemetry


@register("fact_epoch_rejects")
def fact_epoch_rejects(f: Frames):
    """Valid rows of both topics that the facts leave out for their epoch."""
    return (gold.epoch_rejects(f.silver_rides).select(F.lit("ride_events").alias("source"), "*")
            .unionByName(gold.epoch_rejects(f.silver_telemetry).select(F.lit("telemetry").alias("source"), "*")))


@register("dim_payment_method")
def dim_payment_method(f: Frames):
    return gold.dim_payment_method(f.fact_rides)


@register("dim_city")
def dim_city(f: Frames):
    return gold.dim_city(f.fact_rides)


@register("dim_time_hourly")
def dim_time_hourly(f: Frames):
    return gold.dim_time_hourly(f.fact_rides, f.fact_telemetry)


# --- marts ---------------------------------------------------------------------------

@register("mart_revenue", digits=6)
def mart_revenue(f: Frames):
    return f.mart_revenue


@register("mart_fleet_health", digits=6)
def mart_fleet_health(f: Frames):
    return f.mart_fleet


@register("mart_revenue_minutely", digits=6)
def mart_revenue_minutely(f: Frames):
    """The reference's default 1-minute window."""
    return marts.revenue_mart(f.fact_rides, window="1 minute", exact=True)


@register("mart_fleet_health_minutely", digits=6)
def mart_fleet_health_minutely(f: Frames):
    return marts.fleet_mart(f.fact_telemetry, window="1 minute", exact=True)


@register("mart_revenue_default", digits=6)
def mart_revenue_default(f: Frames):
    """The default form (estimated ``completed_rides``) with the exact count beside it."""
    return marts.beside_exact(marts.revenue_mart(f.fact_rides, window=f.window), f.mart_revenue, marts.REVENUE_COUNTS)


@register("mart_fleet_health_default", digits=6)
def mart_fleet_health_default(f: Frames):
    """The default form (four estimated counts) with the exact counts beside it."""
    return marts.beside_exact(marts.fleet_mart(f.fact_telemetry, window=f.window), f.mart_fleet, marts.FLEET_COUNTS)


@register("mart_revenue_approx_bounds")
def mart_revenue_approx_bounds(f: Frames):
    """HLL ``completed_rides`` checked against the exact count per window."""
    est = marts.revenue_with_estimate(f.fact_rides, window=f.window)
    return est.select("hour_start", "hour_end", "completed_rides",
                      marts.within_hll_bound(F.col("approx_completed_rides"), F.col("completed_rides"))
                      .alias("completed_rides_within_bound"))


@register("mart_fleet_approx_bounds")
def mart_fleet_approx_bounds(f: Frames):
    """The four HLL fleet counts checked against exact counts per window."""
    m = marts.fleet_mart(f.fact_telemetry, window=f.window, exact=True, with_estimates=True)
    return m.select("hour_start", "hour_end", "fleet_size_seen",
                    *[marts.within_hll_bound(F.col(f"approx_{n}"), F.col(n)).alias(f"{n}_within_bound")
                      for n in marts.FLEET_COUNTS])


# --- validation ------------------------------------------------------------------------

@register("fact_overview")
def fact_overview(f: Frames):
    return quality.fact_overview(f.fact_rides, f.fact_telemetry)


@register("mart_bounds")
def mart_bounds(f: Frames):
    return quality.mart_bounds(f.mart_revenue)


@register("revenue_reconciliation")
def revenue_reconciliation(f: Frames):
    t = StoredTables(f, telemetry=False)
    return quality.revenue_reconciliation(t.fact_rides, t.mart_revenue)


@register("revenue_totals", digits=6)
def revenue_totals(f: Frames):
    return quality.revenue_totals(f.mart_revenue)


@register("fleet_totals")
def fleet_totals(f: Frames):
    return quality.fleet_totals(f.mart_fleet)


@register("fleet_bound")
def fleet_bound(f: Frames):
    t = StoredTables(f, rides=False)
    return quality.fleet_bound(t.fact_telemetry, t.mart_fleet)


@register("fact_rides_null_checks")
def fact_rides_null_checks(f: Frames):
    return quality.null_checks(f.fact_rides, quality.RIDE_CRITICAL)


@register("fact_telemetry_null_checks")
def fact_telemetry_null_checks(f: Frames):
    return quality.null_checks(f.fact_telemetry, quality.TELEMETRY_CRITICAL)


@register("mart_revenue_null_checks")
def mart_revenue_null_checks(f: Frames):
    return quality.null_checks(f.mart_revenue, quality.REVENUE_MART_CRITICAL)


@register("mart_fleet_null_checks")
def mart_fleet_null_checks(f: Frames):
    return quality.null_checks(f.mart_fleet, quality.FLEET_MART_CRITICAL)


@register("fare_distance_quality")
def fare_distance_quality(f: Frames):
    return quality.fare_distance_quality(f.fact_rides)


@register("zero_fares")
def zero_fares(f: Frames):
    """Zero fares, reported but not a check."""
    return quality.fare_distance_quality(f.fact_rides).select("zero_fares")


@register("battery_quality")
def battery_quality(f: Frames):
    return quality.battery_quality(f.fact_telemetry)


@register("validation_report")
def validation_report(f: Frames):
    """The nine checks over stored gold and mart tables (the reference's validation job)."""
    t = StoredTables(f)
    return quality.validation_report(t.fact_rides, t.fact_telemetry, t.mart_revenue, t.mart_fleet)


@register("validation_report_faulty")
def validation_report_faulty(f: Frames):
    """The same report over tables with faults: every check fails."""
    return quality.validation_report(*with_faults(StoredTables(f)))


@register("validation_summary")
def validation_summary(f: Frames):
    t = StoredTables(f)
    return quality.report_summary(
        quality.validation_report(t.fact_rides, t.fact_telemetry, t.mart_revenue, t.mart_fleet))


# --- reports ----------------------------------------------------------------------------

@register("latest_revenue_windows", digits=6)
def latest_revenue_windows(f: Frames):
    return reports.latest_windows(f.mart_revenue, 3)


@register("latest_fleet_windows", digits=6)
def latest_fleet_windows(f: Frames):
    return reports.latest_windows(f.mart_fleet, 3)


@register("kpi_revenue", digits=6)
def kpi_revenue(f: Frames):
    return reports.kpi_revenue(f.mart_revenue)


@register("kpi_fleet", digits=6)
def kpi_fleet(f: Frames):
    return reports.kpi_fleet(f.mart_fleet)


@register("series_revenue", digits=6)
def series_revenue(f: Frames):
    return reports.series(f.mart_revenue, "total_revenue")


@register("series_battery", digits=6)
def series_battery(f: Frames):
    return reports.series(f.mart_fleet, "avg_battery_level")


@register("last10_revenue", digits=6)
def last10_revenue(f: Frames):
    return reports.last_n(f.mart_revenue, 10)


@register("last10_fleet", digits=6)
def last10_fleet(f: Frames):
    return reports.last_n(f.mart_fleet, 10)


@register("series_revenue_text_times", digits=6)
def series_revenue_text_times(f: Frames):
    """A mart whose times are text in several forms, some unreadable."""
    t = F.col("hour_start")
    forms = ["yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ss"]
    text = F.when(F.hour(t) == 23, F.lit("no time"))
    for k, form in enumerate(forms):
        text = text.when(F.hour(t) % 3 == k, F.date_format(t, form))
    return reports.series(f.mart_revenue.withColumn("hour_start", text), "total_revenue")


@register("kpi_absent_columns", digits=6)
def kpi_absent_columns(f: Frames):
    """Reports over marts that lack the columns they ask for (P19): no mean, zero sums, no series."""
    fleet = f.mart_fleet.drop("avg_battery_level", "low_battery_scooters")
    points = reports.series(f.mart_fleet.drop("avg_battery_level"), "avg_battery_level")
    return reports.kpi_fleet(fleet).withColumn("points", points.agg(F.count(F.lit(1))).scalar())


@register("silver_schema_merge")
def silver_schema_merge(f: Frames):
    """Valid rides stored before and after the payload gained ``city``, read as one table."""
    from velolake.streaming.lake import Lake
    lake = Lake.fresh(f.spark, "merge")
    path = lake.table("silver", "ride_events")
    f.silver_rides.where("user_id % 2 = 0").drop("city").write.mode("append").parquet(path)
    f.silver_rides.where("user_id % 2 <> 0").write.mode("append").parquet(path)
    return lake.read(f.spark, "silver", "ride_events", merge_schema=True).select(*schemas.SILVER_RIDES.fieldNames())


# --- marts of sketches ------------------------------------------------------------------

def _minute_sketches(f: Frames, rides: bool):
    """Stored facts, and beside them their mart of minute sketches, stored too."""
    from velolake.operators import sketches
    from velolake.streaming.lake import Lake
    lake = Lake.fresh(f.spark, "sketches")
    fact, mart = ("fact_rides", "mart_revenue_sketch") if rides else ("fact_telemetry", "mart_fleet_sketch")
    make = sketches.revenue_sketch_mart if rides else sketches.fleet_sketch_mart
    (f.fact_rides if rides else f.fact_telemetry).write.parquet(lake.table("gold", fact))
    facts = lake.read(f.spark, "gold", fact)
    make(facts, "1 minute").write.parquet(lake.table("mart", mart))
    return facts, lake.read(f.spark, "mart", mart), make


def _rolled_up(f: Frames, rides: bool):
    """Hours from minute sketches, with the exact counts, whether each estimate is within its
    bound, and whether all equal those of sketches taken over the hour directly."""
    from velolake.operators import marts, sketches
    facts, minutes, make = _minute_sketches(f, rides)
    counts = sketches.REVENUE_SKETCHES if rides else sketches.FLEET_SKETCHES
    hours = sketches.estimates(sketches.rollup(minutes, f.window))
    direct = sketches.estimates(make(facts, f.window)).select("hour_start", *[F.col(c).alias(f"direct_{c}") for c in counts])
    both = hours.select("hour_start", *counts).unionByName(direct, allowMissingColumns=True)
    equal = [F.max(c) == F.max(f"direct_{c}") for c in counts]
    same = both.groupBy("hour_start").agg(reduce(Column.__and__, equal).alias("equals_direct"))
    exact = (marts.revenue_mart if rides else marts.fleet_mart)(facts, window=f.window, exact=True)
    shown = marts.beside_exact(hours, exact, counts, sketches.BOUND)
    return shown.unionByName(same, allowMissingColumns=True).groupBy("hour_start").agg(
        *[F.max(c).alias(c) for c in [*shown.columns[1:], "equals_direct"]])


@register("mart_revenue_rollup", digits=6)
def mart_revenue_rollup(f: Frames):
    """The hourly revenue mart rolled up from stored minute sketches (A5, M1)."""
    return _rolled_up(f, True)


@register("mart_fleet_rollup", digits=6)
def mart_fleet_rollup(f: Frames):
    """The hourly fleet mart rolled up from stored minute sketches."""
    return _rolled_up(f, False)


@register("fleet_totals_distinct")
def fleet_totals_distinct(f: Frames):
    """Fleet totals that count a scooter once however many windows it is in (V6), from the minute
    sketches alone; beside each whether it is within its bound of the exact count over the facts."""
    from velolake import constants as K
    from velolake.operators import sketches
    facts, minutes, _ = _minute_sketches(f, False)
    sid, status = F.col("scooter_id"), F.col("scooter_status")
    flags = [F.lit(True), F.col("battery_level") < K.LOW_BATTERY_THRESHOLD, status == "in_use", status == "maintenance"]
    per_scooter = facts.where(sid.isNotNull()).groupBy(sid).agg(
        *[F.max(flag).alias(c) for c, flag in zip(sketches.FLEET_SKETCHES, flags)])
    exact = per_scooter.agg(F.struct(*[F.count_if(c).alias(c) for c in sketches.FLEET_SKETCHES])).scalar()
    total = sketches.total_distinct(minutes)
    return total.select("windows", *[exact[c].alias(c) for c in sketches.FLEET_SKETCHES], *[
        sketches.within_bound(F.col(c), exact[c]).alias(f"{c}_within_bound") for c in sketches.FLEET_SKETCHES])
