"""Stored distinct-count sketches: marts that roll up.

The marts keep the *estimate* of a window, and estimates cannot be added: a scooter seen in sixty
minutes would count sixty times.  These marts keep the sketch instead, as bytes of a fixed size.
Sketches of several windows merge into the sketch of all their rows, so minutes roll up to hours
or days, and totals count a scooter once, without the facts.  Sums are kept beside their counts,
so averages roll up too.

A sketch has ``2 ** lg_k`` registers; its relative standard error is about
``1.04 / sqrt(2 ** lg_k)`` (1.6 % at 12), a few KB a window at most, however many rows it stands for.
Every aggregate here is partial before its shuffle: a task sends one row a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake import constants as K
from velolake.functions.measures import ratio
from velolake.functions.time import tumbling
from velolake.operators.marts import fleet_base, revenue_base, within_hll_bound

LG_K = 12
BOUND = 5 * 1.04 / (1 << LG_K) ** 0.5

REVENUE_SKETCHES = ["completed_rides"]
FLEET_SKETCHES = ["fleet_size_seen", "low_battery_scooters", "scooters_in_use", "scooters_in_maintenance"]
REVENUE_SUMS = ["fare_amount", "distance_km", "duration_mins"]
FLEET_SUMS = ["battery_level"]


def _sketch_mart(base: DataFrame, window: str, keys: dict[str, Column], sums: list[str], lg_k: int) -> DataFrame:
    measures = [f(c).alias(f"{name}_{c}") for c in sums for name, f in (("sum", F.sum), ("count", F.count))]
    # hll_sketch_agg leaves NULLs out; a window without any key has an empty sketch
    return (base.groupBy(tumbling("event_ts", window).alias("w"))
            .agg(*[F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"{k}_sketch") for k, c in keys.items()], *measures)
            .select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                    *[f"{k}_sketch" for k in keys], *[f"{f}_{c}" for c in sums for f in ("sum", "count")]))


def revenue_sketch_mart(facts: DataFrame, window: str = K.MART_WINDOW_DURATION, watermark: str | None = None,
                        lg_k: int = LG_K) -> DataFrame:
    """Completed rides per window as a sketch of their ids, with sums and counts of the measures.
    Works in batch and, under a watermark, as a stream."""
    return _sketch_mart(revenue_base(facts, watermark), window, {"completed_rides": F.col("ride_id")}, REVENUE_SUMS, lg_k)


def fleet_sketch_mart(facts: DataFrame, window: str = K.MART_WINDOW_DURATION, watermark: str | None = None,
                      lg_k: int = LG_K) -> DataFrame:
    """Scooters per window as four sketches: seen, low on battery, in use, in maintenance."""
    sid, status = F.col("scooter_id"), F.col("scooter_status")
    keys = dict(zip(FLEET_SKETCHES, [
        sid, F.when(F.col("battery_level") < K.LOW_BATTERY_THRESHOLD, sid), F.when(status == "in_use", sid),
        F.when(status == "maintenance", sid)]))
    return _sketch_mart(fleet_base(facts, watermark), window, keys, FLEET_SUMS, lg_k)


def _merged(mart: DataFrame, by: list[Column]) -> DataFrame:
    """Sketches and sums of the windows of each group in one row."""
    sketches = [F.hll_union_agg(c).alias(c) for c in mart.columns if c.endswith("_sketch")]
    sums = [F.sum(c).alias(c) for c in mart.columns if c.startswith(("sum_", "count_"))]
    return mart.groupBy(*by).agg(F.count(F.lit(1)).alias("windows"), *sketches, *sums)


def rollup(mart: DataFrame, window: str) -> DataFrame:
    """A sketch mart of wider windows from one of narrower windows that divide them: same columns,
    so it can be stored or rolled up again."""
    wide = _merged(mart, [tumbling("hour_start", window).alias("w")])
    return wide.select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                       *[c for c in mart.columns if c not in ("hour_start", "hour_end")])


def _estimate(sketch: str) -> Column:
    """A sketch's count from its registers alone.  A sketch that rows came to in order also knows
    a running estimate, which a merge loses; merged with itself, sketches of equal registers give
    equal numbers however they came about."""
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))


def estimates(mart: DataFrame) -> DataFrame:
    """A sketch mart's counts as numbers and its averages, under the names of the plain marts."""
    counts = [c[: -len("_sketch")] for c in mart.columns if c.endswith("_sketch")]
    sums = [c[len("sum_"):] for c in mart.columns if c.startswith("sum_")]
    total = {"fare_amount": "total_revenue", "distance_km": "total_distance_km"}
    return mart.select("hour_start", "hour_end", *[_estimate(f"{c}_sketch").alias(c) for c in counts],
                       *[F.col(f"sum_{c}").alias(total[c]) for c in sums if c in total],
                       *[ratio(F.col(f"sum_{c}"), F.col(f"count_{c}")).alias(f"avg_{c}") for c in sums])


def total_distinct(mart: DataFrame) -> DataFrame:
    """One row over all windows: each sketch's distinct keys, a key of many windows once (the
    sums of a plain mart's counts repeat it), and the number of windows."""
    counts = [c[: -len("_sketch")] for c in mart.columns if c.endswith("_sketch")]
    return _merged(mart, []).select("windows", *[
        F.coalesce(_estimate(f"{c}_sketch"), F.lit(0)).alias(c) for c in counts])


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether an estimate lies within five standard errors of the exact count."""
    return within_hll_bound(estimate, exact, rel=BOUND)
