"""Mart layer: tumbling-window KPI tables (M1, M2).

Two modes share one definition and work in batch and in streaming:

* ``exact=False`` (default): distinct counts are HyperLogLog++ estimates
  (``approx_count_distinct``, 5 % relative error).  One partial/final aggregate per
  window; a task sends one row a window.
* ``exact=True``: distinct counts are exact.  Sums and averages are the same in both
  modes, plain aggregates of the double values as they come.

Exact revenue in batch adds the counts of distinct (window, ride) pairs, the only rows
that are shuffled one by one, to the sums per window.  Exact fleet counts come from one
row per (window, scooter).  In streaming both are two chained stateful aggregations under
one watermark, with one state row per (window, key) until the window closes: prefer the
default mode, or RocksDB state, where a window holds very many keys.

With ``watermark`` set the input gets ``withWatermark("event_ts", watermark)``; in
append mode a window is emitted once the watermark passes its end.  The revenue
filter on ``event_type`` comes before the watermark, so only completed rides move it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake import constants as K
from velolake.functions.measures import ratio
from velolake.functions.time import tumbling


def _window_of(df: DataFrame, duration: str) -> Column:
    return tumbling("event_ts", duration)


def _rewindow(df: DataFrame, duration: str) -> Column:
    """Group key for the second level: the same window.  A stream needs it rebuilt from
    ``window_time`` so the watermark keeps tracking it."""
    if df.isStreaming:
        return F.window(F.window_time(F.col("w")), duration)
    return F.col("w")


def _bounds(w: str = "w") -> list[Column]:
    return [F.col(f"{w}.start").alias("hour_start"), F.col(f"{w}.end").alias("hour_end")]


def revenue_base(fact_rides_df: DataFrame, watermark: str | None = None) -> DataFrame:
    base = (fact_rides_df
            .filter(F.col("event_type") == F.lit(K.COMPLETED_EVENT_TYPE))
            .filter(F.col("event_ts").isNotNull()))
    if watermark:
        base = base.withWatermark("event_ts", watermark)
    return base


def fleet_base(fact_telemetry_df: DataFrame, watermark: str | None = None) -> DataFrame:
    base = fact_telemetry_df.filter(F.col("event_ts").isNotNull())
    if watermark:
        base = base.withWatermark("event_ts", watermark)
    return base


REVENUE_INPUTS = ("fare_amount", "distance_km", "duration_mins")


def _revenue_measures() -> list[Column]:
    return [F.sum("fare_amount").alias("total_revenue"), F.avg("fare_amount").alias("avg_fare_amount"),
            F.sum("distance_km").alias("total_distance_km"), F.avg("distance_km").alias("avg_distance_km"),
            F.avg("duration_mins").alias("avg_duration_mins")]


def revenue_mart(fact_rides_df: DataFrame, window: str = K.MART_WINDOW_DURATION,
                 exact: bool = False, watermark: str | None = None) -> DataFrame:
    """Completed rides per window: rides, revenue, distance and duration KPIs."""
    base = revenue_base(fact_rides_df, watermark)
    if not exact:
        return (base.groupBy(_window_of(base, window).alias("w"))
                .agg(F.approx_count_distinct("ride_id").alias("completed_rides"), *_revenue_measures())
                .select(*_bounds(), "completed_rides", "total_revenue", "avg_fare_amount",
                        "total_distance_km", "avg_distance_km", "avg_duration_mins"))
    if not base.isStreaming:
        sums = base.groupBy(_window_of(base, window).alias("w")).agg(*_revenue_measures())
        pairs = base.select(_window_of(base, window).alias("w"), "ride_id").distinct()
        rides = pairs.groupBy("w").agg(F.count("ride_id").alias("completed_rides"))
        names = [c for c in sums.columns if c != "w"]
        both = sums.unionByName(rides, allowMissingColumns=True).groupBy("w").agg(
            *[F.max(c).alias(c) for c in ["completed_rides", *names]])
        return both.select(*_bounds(), "completed_rides", *names)
    per_ride = (base.groupBy(_window_of(base, window).alias("w"), "ride_id")
                .agg(*[f(c).alias(f"{f.__name__}_{c}") for c in REVENUE_INPUTS for f in (F.sum, F.count)]))
    per_window = (per_ride.groupBy(_rewindow(per_ride, window).alias("w"))
                  .agg(F.count("ride_id").alias("completed_rides"),
                       *[F.sum(f"{f}_{c}").alias(f"{f}_{c}") for c in REVENUE_INPUTS for f in ("sum", "count")]))
    mean = {c: ratio(F.col(f"sum_{c}"), F.col(f"count_{c}")) for c in REVENUE_INPUTS}
    return per_window.select(
        *_bounds(), "completed_rides",
        F.col("sum_fare_amount").alias("total_revenue"), mean["fare_amount"].alias("avg_fare_amount"),
        F.col("sum_distance_km").alias("total_distance_km"), mean["distance_km"].alias("avg_distance_km"),
        mean["duration_mins"].alias("avg_duration_mins"))


def fleet_mart(fact_telemetry_df: DataFrame, window: str = K.MART_WINDOW_DURATION,
               exact: bool = False, watermark: str | None = None,
               with_estimates: bool = False) -> DataFrame:
    """Scooters seen per window, average battery, and scooters low on battery / in use /
    in maintenance.  A scooter seen with several statuses in a window counts in each.

    ``with_estimates`` (exact mode only) adds the HyperLogLog estimates of the four
    counts, computed over the same per-scooter rows (HLL ignores duplicates), as
    ``approx_<name>`` columns.
    """
    base = fleet_base(fact_telemetry_df, watermark)
    sid = F.col("scooter_id")
    low = F.col("battery_level") < F.lit(K.LOW_BATTERY_THRESHOLD)
    in_use = F.col("scooter_status") == F.lit("in_use")
    maint = F.col("scooter_status") == F.lit("maintenance")
    if not exact:
        return (base.groupBy(_window_of(base, window).alias("w"))
                .agg(F.approx_count_distinct(sid).alias("fleet_size_seen"),
                     F.avg("battery_level").alias("avg_battery_level"),
                     F.approx_count_distinct(F.when(low, sid)).alias("low_battery_scooters"),
                     F.approx_count_distinct(F.when(in_use, sid)).alias("scooters_in_use"),
                     F.approx_count_distinct(F.when(maint, sid)).alias("scooters_in_maintenance"))
                .select(*_bounds(), "fleet_size_seen", "avg_battery_level", "low_battery_scooters",
                        "scooters_in_use", "scooters_in_maintenance"))
    per_scooter = (base.groupBy(_window_of(base, window).alias("w"), "scooter_id")
                   .agg(F.sum("battery_level").alias("batt"),
                        F.count("battery_level").alias("n_batt"),
                        F.max(low).alias("low"),          # seen low / in use / in maintenance
                        F.max(in_use).alias("in_use"),    # at least once in the window
                        F.max(maint).alias("maint")))
    known = sid.isNotNull()
    measures = [
        F.count(sid).alias("fleet_size_seen"),
        F.sum("batt").alias("batt"),
        F.sum("n_batt").alias("n_batt"),
        F.count_if(known & F.col("low")).alias("low_battery_scooters"),
        F.count_if(known & F.col("in_use")).alias("scooters_in_use"),
        F.count_if(known & F.col("maint")).alias("scooters_in_maintenance"),
    ]
    extra = []
    if with_estimates:
        measures += [
            F.approx_count_distinct(sid).alias("approx_fleet_size_seen"),
            F.approx_count_distinct(F.when(F.col("low"), sid)).alias("approx_low_battery_scooters"),
            F.approx_count_distinct(F.when(F.col("in_use"), sid)).alias("approx_scooters_in_use"),
            F.approx_count_distinct(F.when(F.col("maint"), sid)).alias("approx_scooters_in_maintenance"),
        ]
        extra = ["approx_fleet_size_seen", "approx_low_battery_scooters", "approx_scooters_in_use",
                 "approx_scooters_in_maintenance"]
    per_window = per_scooter.groupBy(_rewindow(per_scooter, window).alias("w")).agg(*measures)
    return per_window.select(
        *_bounds(),
        "fleet_size_seen",
        ratio(F.col("batt"), F.col("n_batt")).alias("avg_battery_level"),
        "low_battery_scooters",
        "scooters_in_use",
        "scooters_in_maintenance",
        *extra,
    )


def revenue_with_estimate(fact_rides_df: DataFrame, window: str = K.MART_WINDOW_DURATION) -> DataFrame:
    """Exact and HLL completed-ride counts per window, from one two-level aggregate."""
    base = revenue_base(fact_rides_df)
    per_ride = base.groupBy(_window_of(base, window).alias("w"), "ride_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_ride.groupBy(F.col("w"))
            .agg(F.count("ride_id").alias("completed_rides"),
                 F.approx_count_distinct("ride_id").alias("approx_completed_rides"))
            .select(*_bounds(), "completed_rides", "approx_completed_rides"))


# approx_count_distinct at its default 5 % keeps 2 ** 9 registers; one register's worth of
# standard error is 1.04 / sqrt(512), and five of them are never met by chance.
HLL_REGISTERS = 512
HLL_BOUND = 5 * 1.04 / HLL_REGISTERS ** 0.5
HLL_SLACK = 3  # small counts: registers that collide


def within_hll_bound(approx: Column, exact: Column, slack: int = HLL_SLACK, rel: float = HLL_BOUND) -> Column:
    """``|approx - exact| <= max(slack, rel * exact)``."""
    return F.abs(approx - exact) <= F.greatest(F.lit(float(slack)), F.lit(rel) * exact)


def beside_exact(estimated: DataFrame, exact: DataFrame, counts: list[str], rel: float = HLL_BOUND) -> DataFrame:
    """The windows of a default-mode mart: its own measures, and for each estimated count
    the exact one and whether the estimate is within the sketch's bound.  Lined up by union
    and group-by; both sides are one row a window."""
    others = [c for c in estimated.columns if c not in ("hour_start", "hour_end", *counts)]
    both = estimated.select("hour_start", "hour_end", *others, *[F.col(c).alias(f"est_{c}") for c in counts],
                            F.lit(1).alias("own")).unionByName(
        exact.select("hour_start", "hour_end", *counts), allowMissingColumns=True)
    per_window = both.groupBy("hour_start", "hour_end").agg(
        *[F.max(c).alias(c) for c in both.columns if c not in ("hour_start", "hour_end")]).where("own = 1")
    return per_window.select("hour_start", "hour_end", *counts, *[
        within_hll_bound(F.col(f"est_{c}"), F.col(c), rel=rel).alias(f"{c}_within_bound") for c in counts], *others)


REVENUE_COUNTS = ["completed_rides"]
FLEET_COUNTS = ["fleet_size_seen", "low_battery_scooters", "scooters_in_use", "scooters_in_maintenance"]
