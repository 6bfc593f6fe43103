"""Incremental reconciliation (V3, V5, V7-V14, V16): the nine checks, of what came since the last run.

The full report reads all facts each time.  Here a run reads the fact batches and the finalised
mart windows that no run has looked at, adds its figures to a ledger, and reports from the ledger
alone: completed rides per window, scooters seen, and one row of figures a run.  Facts lie in a
folder a batch (``start_gold_topics``), so the scan skips the batches of earlier runs; a mart's
windows are finalised in order, so its new ones start where the last run ended.

A run's row is written last, with what the next one has to start from.  A run that fails before
that leaves nothing that counts: the next one has its number and overwrites what it wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import constants as K
from velolake.functions.measures import null_count
from velolake.functions.time import tumbling
from velolake.operators import quality as Q
from velolake.sources.tables import is_missing
from velolake.streaming.dims import BATCH_COL
from velolake.streaming.lake import Lake

RIDE_FIGURES = [f"null_{c}" for c in Q.RIDE_CRITICAL] + ["negative_fares", "negative_distances"]
TELEMETRY_FIGURES = [f"null_{c}" for c in Q.TELEMETRY_CRITICAL] + ["invalid_battery"]
_WINDOWS = "window_start timestamp, completed long, " + ", ".join(f"{c} long" for c in RIDE_FIGURES) + ", run long"
_SCOOTERS = "scooter_id string, run long"
_RUNS = ("rides_batch long, telemetry_batch long, revenue_lo timestamp, revenue_hi timestamp, fleet_hi timestamp, "
         + ", ".join(f"{c} long" for c in [*(f"rides_{c}" for c in RIDE_FIGURES), *(f"telemetry_{c}" for c in TELEMETRY_FIGURES),
                                            "new_scooters", "mart_rides", "revenue_nulls", "fleet_nulls", "most_scooters"]) + ", run long")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        return spark.createDataFrame([], schema)


def _nulls(columns: list[str]) -> Column:
    return Q._sum_of([null_count(c) for c in columns])


def new_batches(facts: DataFrame, after: int | None, upto: int | None) -> DataFrame:
    """The rows of the batches from behind ``after`` up to ``upto``; earlier folders are not read."""
    rows = facts.where(F.col(BATCH_COL) <= F.lit(upto).cast("long"))
    return rows if after is None else rows.where(F.col(BATCH_COL) > after)


def new_windows(mart: DataFrame, after) -> DataFrame:
    """The windows that a mart has finalised since its last ``hour_end``, ``after``."""
    return mart if after is None else mart.where(F.col("hour_start") >= F.lit(after))


def run_audit(spark: SparkSession, lake: Lake, window: str = K.MART_WINDOW_DURATION) -> int:
    """Look at what came since the last run and add it to the ledger; returns the run's number.
    ``window`` is the revenue mart's."""
    folder = lake.table("audit", "")
    runs = _read(spark, f"{folder}runs", _RUNS)
    last = runs.agg(*[F.max(c).alias(c) for c in ("run", "rides_batch", "telemetry_batch", "revenue_hi", "fleet_hi")]).first()
    run = 0 if last["run"] is None else last["run"] + 1
    rides, telemetry = (df if BATCH_COL in df.columns else df.withColumn(BATCH_COL, F.lit(None).cast("long"))  # no batch yet
                        for df in (lake.read(spark, "gold", t) for t in ("fact_rides", "fact_telemetry")))
    revenue = new_windows(lake.read(spark, "mart", "mart_revenue_hourly"), last["revenue_hi"])
    fleet = new_windows(lake.read(spark, "mart", "mart_fleet_health_hourly"), last["fleet_hi"])
    # What is there now; the folders of batches that come meanwhile are left to the next run.
    rides_to, telemetry_to = (df.agg(F.max(BATCH_COL)).first()[0] for df in (rides, telemetry))

    # One row a window and task leaves the scan, as one row a scooter does below.
    ended = F.col("event_type") == K.COMPLETED_EVENT_TYPE
    windows = new_batches(rides, last["rides_batch"], rides_to).groupBy(tumbling("event_ts", window)["start"].alias("window_start")).agg(
        F.count_if(ended).alias("completed"), *[null_count(c).alias(f"null_{c}") for c in Q.RIDE_CRITICAL],
        F.count_if(F.col("fare_amount") < 0).alias("negative_fares"), F.count_if(F.col("distance_km") < 0).alias("negative_distances"))
    windows.write.mode("overwrite").parquet(f"{folder}windows/run={run}")
    b = F.col("battery_level")
    scooters = new_batches(telemetry, last["telemetry_batch"], telemetry_to).groupBy("scooter_id").agg(
        *[null_count(c).alias(f"null_{c}") for c in Q.TELEMETRY_CRITICAL if c != "scooter_id"],
        F.count_if(F.col("scooter_id").isNull()).alias("null_scooter_id"), F.count_if((b < 0) | (b > 100)).alias("invalid_battery"))
    scooters.write.mode("overwrite").parquet(f"{folder}telemetry/run={run}")
    scooters = spark.read.schema("scooter_id string, " + ", ".join(f"{c} long" for c in TELEMETRY_FIGURES)).parquet(f"{folder}telemetry/run={run}")
    before = _read(spark, f"{folder}scooters", _SCOOTERS).where(F.col("run") < run).select("scooter_id", F.lit(1).alias("old"))
    fresh = scooters.select("scooter_id", F.lit(None).cast("int").alias("old")).unionByName(before).groupBy("scooter_id").agg(
        F.max("old").alias("old")).where("old is null").select("scooter_id")
    fresh.write.mode("overwrite").parquet(f"{folder}scooters/run={run}")

    counted = _read(spark, f"{folder}windows", _WINDOWS).where(F.col("run") == run)
    first = counted.agg(F.struct(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in RIDE_FIGURES])).scalar()
    second = scooters.agg(F.struct(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TELEMETRY_FIGURES])).scalar()
    third = revenue.agg(F.struct(F.min("hour_start").alias("lo"), F.max("hour_end").alias("hi"),
                                 F.coalesce(F.sum("completed_rides"), F.lit(0)).alias("total"),
                                 _nulls(Q.REVENUE_MART_CRITICAL).alias("nulls"))).scalar()
    fourth = fleet.agg(F.struct(F.max("hour_end").alias("hi"), F.max("fleet_size_seen").alias("most"),
                                _nulls(Q.FLEET_MART_CRITICAL).alias("nulls"))).scalar()
    new = _read(spark, f"{folder}scooters", _SCOOTERS).where(F.col("run") == run).agg(F.count(F.lit(1)).alias("new_scooters"))
    new.select(
        F.lit(rides_to).cast("long").alias("rides_batch"), F.lit(telemetry_to).cast("long").alias("telemetry_batch"),
        third["lo"].alias("revenue_lo"), third["hi"].alias("revenue_hi"), fourth["hi"].alias("fleet_hi"),
        *[first[c].alias(f"rides_{c}") for c in RIDE_FIGURES], *[second[c].alias(f"telemetry_{c}") for c in TELEMETRY_FIGURES],
        "new_scooters", third["total"].alias("mart_rides"), third["nulls"].alias("revenue_nulls"), fourth["nulls"].alias("fleet_nulls"),
        fourth["most"].alias("most_scooters")).write.mode("overwrite").parquet(f"{folder}runs/run={run}")
    return run


def audit_report(spark: SparkSession, lake: Lake, tolerance_pct: float = K.REVENUE_DIFF_TOLERANCE_PCT) -> DataFrame:
    """The nine checks ``(check, passed, observed, limit)`` over all runs, as ``validation_report``
    gives them over the whole tables."""
    folder = lake.table("audit", "")
    extremes = {"revenue_lo": F.min, "revenue_hi": F.max, "most_scooters": F.max}
    sums = [f for f in _read(spark, f"{folder}runs", _RUNS).columns if f not in (*extremes, "run", "rides_batch", "telemetry_batch", "fleet_hi")]
    runs = _read(spark, f"{folder}runs", _RUNS)
    total = runs.agg(*[f(c).alias(c) for c, f in extremes.items()], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    bounds = runs.agg(F.struct(F.min("revenue_lo").alias("lo"), F.max("revenue_hi").alias("hi"), F.max("run").alias("run"))).scalar()
    start = F.col("window_start")  # a failed run's windows have a number that no run's row has
    facts = _read(spark, f"{folder}windows", _WINDOWS).where((F.col("run") <= bounds["run"]) & (start >= bounds["lo"]) & (start < bounds["hi"])).agg(
        F.coalesce(F.sum("completed"), F.lit(0))).scalar()
    zero, fact_n = F.lit(0), F.col("fact_rides")
    diff_pct = F.when(fact_n > 0, F.abs(fact_n - F.col("mart_rides")) / fact_n * F.lit(100.0)).otherwise(F.lit(0.0))
    rides = Q._sum_of([F.col(f"rides_null_{c}") for c in Q.RIDE_CRITICAL])
    telemetry = Q._sum_of([F.col(f"telemetry_null_{c}") for c in Q.TELEMETRY_CRITICAL])
    counts = [(K.CHECK_REVENUE_NULLS, F.col("revenue_nulls")), (K.CHECK_RIDE_NULLS, rides), (K.CHECK_FARES, F.col("rides_negative_fares")),
              (K.CHECK_DISTANCES, F.col("rides_negative_distances")), (K.CHECK_FLEET_NULLS, F.col("fleet_nulls")),
              (K.CHECK_TELEMETRY_NULLS, telemetry), (K.CHECK_BATTERY, F.col("telemetry_invalid_battery"))]
    return total.withColumn("fact_rides", facts).select(Q._checks(
        (K.CHECK_REVENUE_COUNT, diff_pct <= F.lit(float(tolerance_pct)), diff_pct, F.lit(float(tolerance_pct))),
        (K.CHECK_FLEET_MAX, F.coalesce(F.col("most_scooters") <= F.col("new_scooters"), F.lit(True)), F.col("most_scooters"), F.col("new_scooters")),
        *[(name, n == zero, n, zero) for name, n in counts]))
