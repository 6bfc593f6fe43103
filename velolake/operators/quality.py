"""Batch reconciliation and data-quality checks over gold and mart tables.

A check is one multi-measure aggregate over its table; values that it needs from another
table (mart bounds, distinct scooters) come in as scalar subqueries, one-row results, so
no check joins two tables.  The report reads each of its four tables once.
The report is a DataFrame ``(check, passed, observed, limit)``; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake import constants as K
from velolake.functions.measures import null_count

RIDE_CRITICAL = ["ride_id", "event_ts", "fare_amount", "scooter_id", "user_id"]
TELEMETRY_CRITICAL = ["scooter_id", "event_ts", "battery_level", "scooter_status"]
REVENUE_MART_CRITICAL = ["completed_rides", "total_revenue", "hour_start"]
FLEET_MART_CRITICAL = ["fleet_size_seen", "avg_battery_level", "hour_start"]


def fact_overview(fact_rides: DataFrame, fact_telemetry: DataFrame) -> DataFrame:
    """Rows and event-time range of each fact table (V1)."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return (df.agg(F.count(F.lit(1)).alias("rows"),
                       F.min("event_ts").alias("min_event_ts"),
                       F.max("event_ts").alias("max_event_ts"))
                .select(F.lit(name).alias("table"), "rows", "min_event_ts", "max_event_ts"))
    return one(fact_rides, "fact_rides").unionByName(one(fact_telemetry, "fact_telemetry"))


def mart_bounds(mart_revenue: DataFrame) -> DataFrame:
    """First window start and last window end of the revenue mart (V2)."""
    return mart_revenue.agg(F.min("hour_start").alias("min_hour_start"),
                            F.max("hour_end").alias("max_hour_end"))


def revenue_reconciliation(fact_rides: DataFrame, mart_revenue: DataFrame,
                           tolerance_pct: float = K.REVENUE_DIFF_TOLERANCE_PCT) -> DataFrame:
    """Completed rides in the facts vs the mart's ``completed_rides`` total (V3).

    Facts are counted over the mart's half-open range ``[min start, max end)``.  An
    empty mart or no completed fact rows gives a difference of 0 and a pass.
    """
    bounds = mart_bounds(mart_revenue)
    lo = bounds.select("min_hour_start").scalar()
    hi = bounds.select("max_hour_end").scalar()
    mart_total = mart_revenue.agg(F.coalesce(F.sum("completed_rides"), F.lit(0)).cast("long")).scalar()
    in_range = fact_rides.filter(F.col("event_type") == F.lit(K.COMPLETED_EVENT_TYPE))
    if "event_date" in fact_rides.columns:
        # date-partitioned facts: the same range on the partition column skips other days' files
        in_range = in_range.filter((F.col("event_date") >= F.to_date(lo)) & (F.col("event_date") <= F.to_date(hi)))
    fact = (in_range
            .filter((F.col("event_ts") >= lo) & (F.col("event_ts") < hi))
            .agg(F.count(F.lit(1)).alias("fact_completed_rides")))
    diff = F.abs(F.col("fact_completed_rides") - F.col("mart_completed_rides"))
    return (fact.select("fact_completed_rides", mart_total.alias("mart_completed_rides"))
            .select("fact_completed_rides", "mart_completed_rides", diff.alias("diff"))
            .withColumn("diff_pct", F.when(F.col("fact_completed_rides") > 0,
                                           F.col("diff") / F.col("fact_completed_rides") * F.lit(100.0))
                        .otherwise(F.lit(0.0)))
            .withColumn("within_tolerance", F.col("diff_pct") <= F.lit(float(tolerance_pct))))


def revenue_totals(mart_revenue: DataFrame) -> DataFrame:
    """Total revenue, total distance and window count of the revenue mart (V4)."""
    return mart_revenue.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_distance_km").alias("total_distance_km"),
        F.count(F.lit(1)).alias("windows"))


def fleet_totals(mart_fleet: DataFrame) -> DataFrame:
    """Sums of the fleet mart's counts across windows, and the window count (V6)."""
    return mart_fleet.agg(
        F.sum("fleet_size_seen").alias("total_fleet_observations"),
        F.sum("low_battery_scooters").alias("total_low_battery"),
        F.sum("scooters_in_use").alias("total_in_use"),
        F.sum("scooters_in_maintenance").alias("total_maintenance"),
        F.count(F.lit(1)).alias("windows"))


def null_checks(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count per column, one aggregate."""
    return df.agg(*[null_count(c).alias(f"null_{c}") for c in columns])


def fare_distance_quality(fact_rides: DataFrame) -> DataFrame:
    """Negative fares, zero fares and negative distances."""
    return fact_rides.agg(
        F.count_if(F.col("fare_amount") < 0).alias("negative_fares"),
        F.count_if(F.col("fare_amount") == 0).alias("zero_fares"),
        F.count_if(F.col("distance_km") < 0).alias("negative_distances"))


def battery_quality(fact_telemetry: DataFrame) -> DataFrame:
    """Battery readings outside [0, 100]."""
    b = F.col("battery_level")
    return fact_telemetry.agg(F.count_if((b < 0) | (b > 100)).alias("invalid_battery"))


def distinct_scooters(fact_telemetry: DataFrame) -> DataFrame:
    """Distinct ``scooter_id`` values (a NULL id counts as one value, like ``distinct().count()``)."""
    return fact_telemetry.select("scooter_id").distinct().agg(F.count(F.lit(1)).alias("distinct_scooters"))


def fleet_bound(fact_telemetry: DataFrame, mart_fleet: DataFrame) -> DataFrame:
    """Largest ``fleet_size_seen`` vs distinct scooters in the facts (V5).  An empty mart passes."""
    scooters = distinct_scooters(fact_telemetry).scalar()
    return (mart_fleet.agg(F.max("fleet_size_seen").alias("max_fleet_size_seen"))
            .select("max_fleet_size_seen", scooters.alias("distinct_scooters"))
            .withColumn("within_bounds",
                        F.coalesce(F.col("max_fleet_size_seen") <= F.col("distinct_scooters"), F.lit(True))))


def _checks(*items: tuple[str, Column, Column, Column]) -> Column:
    return F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                 observed.cast("double").alias("observed"), limit.cast("double").alias("limit"))
        for name, passed, observed, limit in items]))


def _sum_of(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def _total(cols: list[str]) -> Column:
    return _sum_of([F.col(c) for c in cols])


def validation_report(fact_rides: DataFrame, fact_telemetry: DataFrame,
                      mart_revenue: DataFrame, mart_fleet: DataFrame,
                      tolerance_pct: float = K.REVENUE_DIFF_TOLERANCE_PCT) -> DataFrame:
    """The nine pass/warn checks (V16) as rows ``(check, passed, observed, limit)``.

    A failed check is a row with ``passed = false``; nothing raises.
    """
    zero = F.lit(0)

    # Each table is read once.  A mart's figures come as one struct, a scalar subquery; the
    # reconciliation count is a conditional count in fact_rides' one aggregate.
    rev_nulls = [f"null_{c}" for c in REVENUE_MART_CRITICAL]
    fleet_nulls = [f"null_{c}" for c in FLEET_MART_CRITICAL]
    rev = mart_revenue.agg(F.struct(
        F.min("hour_start").alias("lo"), F.max("hour_end").alias("hi"),
        F.coalesce(F.sum("completed_rides"), F.lit(0)).cast("long").alias("total"),
        *[null_count(c).alias(f"null_{c}") for c in REVENUE_MART_CRITICAL])).scalar()
    fleet = mart_fleet.agg(F.struct(
        F.max("fleet_size_seen").alias("most"),
        *[null_count(c).alias(f"null_{c}") for c in FLEET_MART_CRITICAL])).scalar()
    lo, hi, mart_total = rev["lo"], rev["hi"], rev["total"]
    rev_null, fleet_null = (_sum_of([x[c] for c in cols]) for x, cols in ((rev, rev_nulls), (fleet, fleet_nulls)))
    completed = ((F.col("event_type") == F.lit(K.COMPLETED_EVENT_TYPE))
                 & (F.col("event_ts") >= lo) & (F.col("event_ts") < hi))
    ride_nulls = [f"null_{c}" for c in RIDE_CRITICAL]
    fact_n, diff = F.col("fact_completed_rides"), F.abs(F.col("fact_completed_rides") - F.col("mart_completed_rides"))
    diff_pct = F.when(fact_n > 0, diff / fact_n * F.lit(100.0)).otherwise(F.lit(0.0))
    rides = fact_rides.agg(
        *[null_count(c).alias(f"null_{c}") for c in RIDE_CRITICAL],
        F.count_if(F.col("fare_amount") < 0).alias("negative_fares"),
        F.count_if(F.col("distance_km") < 0).alias("negative_distances"),
        F.count_if(completed).alias("fact_completed_rides"),
    ).withColumn("mart_completed_rides", mart_total).select(_checks(
        (K.CHECK_REVENUE_COUNT, diff_pct <= F.lit(float(tolerance_pct)), diff_pct,
         F.lit(float(tolerance_pct))),
        (K.CHECK_REVENUE_NULLS, rev_null == zero, rev_null, zero),
        (K.CHECK_RIDE_NULLS, _total(ride_nulls) == zero, _total(ride_nulls), zero),
        (K.CHECK_FARES, F.col("negative_fares") == zero, F.col("negative_fares"), zero),
        (K.CHECK_DISTANCES, F.col("negative_distances") == zero, F.col("negative_distances"), zero)))

    # fact_telemetry is read once too: a per-scooter partial aggregate gives both the distinct
    # scooter count (one row per scooter, NULL id included) and the check counts.
    tel_nulls = [f"null_{c}" for c in TELEMETRY_CRITICAL]
    b = F.col("battery_level")
    per_scooter = fact_telemetry.groupBy("scooter_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[null_count(c).alias(f"null_{c}") for c in TELEMETRY_CRITICAL if c != "scooter_id"],
        F.count_if((b < 0) | (b > 100)).alias("invalid_battery"))
    telemetry = per_scooter.agg(
        F.count(F.lit(1)).alias("distinct_scooters"),
        F.coalesce(F.sum(F.when(F.col("scooter_id").isNull(), F.col("rows"))), F.lit(0)).alias("null_scooter_id"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in TELEMETRY_CRITICAL if c != "scooter_id"],
        F.coalesce(F.sum("invalid_battery"), F.lit(0)).alias("invalid_battery"),
    ).withColumn("max_fleet_size_seen", fleet["most"]).select(_checks(
        (K.CHECK_FLEET_MAX,
         F.coalesce(F.col("max_fleet_size_seen") <= F.col("distinct_scooters"), F.lit(True)),
         F.col("max_fleet_size_seen"), F.col("distinct_scooters")),
        (K.CHECK_FLEET_NULLS, fleet_null == zero, fleet_null, zero),
        (K.CHECK_TELEMETRY_NULLS, _total(tel_nulls) == zero, _total(tel_nulls), zero),
        (K.CHECK_BATTERY, F.col("invalid_battery") == zero, F.col("invalid_battery"), zero)))

    return rides.unionByName(telemetry)


def report_summary(report: DataFrame) -> DataFrame:
    """Checks passed out of total."""
    return report.agg(F.count_if(F.col("passed")).alias("passed"), F.count(F.lit(1)).alias("total"))
