"""The incremental report equals the full one, run by run, and reads only what is new."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velolake import schemas
from velolake.operators import marts, quality
from velolake.streaming import audit
from velolake.streaming import layers as L
from velolake.streaming.lake import Lake

T0 = dt.datetime(2024, 1, 1)
HOURS = "1 hour"


def facts(spark, lake, batch, hours, faulty=False):
    """A batch of both facts as a topic query writes them: ``hours`` are (first, last)."""
    n = 400
    secs = F.lit(3600 * hours[0]) + F.col("id") * F.lit(3600 * (hours[1] - hours[0]) // n)
    ts = F.timestamp_seconds(F.unix_timestamp(F.lit(T0)) + secs)
    bad = F.col("id") % 50 == 7 if faulty else F.lit(False)
    values = {
        "ride_id": F.when(~bad, F.concat(F.lit(f"R{batch}-"), "id")), "event_ts": ts, "user_id": F.col("id"), "scooter_id": F.concat(F.lit("S-"), F.col("id") % (30 + 10 * batch)),
        "event_type": F.when(F.col("id") % 3 == 0, "start").otherwise("end"), "fare_amount": F.when(bad, -1.0).otherwise(3.0),
        "distance_km": F.when(bad, -2.0).otherwise(1.0), "duration_mins": F.lit(5), "battery_level": F.when(bad, 500).otherwise(F.col("id") % 100),
        "scooter_status": F.when(~bad, F.lit("in_use"))}
    for table, schema in (("fact_rides", schemas.FACT_RIDES), ("fact_telemetry", schemas.FACT_TELEMETRY)):
        spark.range(n, numPartitions=2).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]) \
            .write.mode("overwrite").parquet(f"{lake.table('gold', table)}/batch_id={batch}")


def finalise(spark, lake, upto):
    """Both marts as a stream would have them: windows up to hour ``upto``, appended."""
    for table, fact, make in (("mart_revenue_hourly", "fact_rides", marts.revenue_mart), ("mart_fleet_health_hourly", "fact_telemetry", marts.fleet_mart)):
        whole = make(L.read_gold(spark, lake, fact), HOURS, exact=True).where(F.col("hour_end") <= F.lit(T0 + dt.timedelta(hours=upto)))
        have = lake.read(spark, "mart", table).agg(F.max("hour_end")).first()[0]
        (whole if have is None else whole.where(F.col("hour_start") >= F.lit(have))).write.mode("append").parquet(lake.table("mart", table))


def full(spark, lake):
    return sorted(map(tuple, quality.validation_report(
        *(L.read_gold(spark, lake, t) for t in ("fact_rides", "fact_telemetry")),
        *(lake.read(spark, "mart", t) for t in ("mart_revenue_hourly", "mart_fleet_health_hourly"))).collect()))


def incremental(spark, lake):
    return sorted(map(tuple, audit.audit_report(spark, lake).collect()))


def test_every_run_reports_what_the_full_report_does(spark):
    lake = Lake.fresh(spark, "t-audit")
    steps = [((0, 5), False, 4), ((5, 9), True, 8), ((7, 12), False, 12)]  # the third has rows of closed windows
    for k, (hours, faulty, upto) in enumerate(steps):
        facts(spark, lake, k, hours, faulty)
        finalise(spark, lake, upto)
        assert audit.run_audit(spark, lake, HOURS) == k
        assert incremental(spark, lake) == full(spark, lake)
    verdicts = {c: ok for c, ok, *_ in incremental(spark, lake)}
    assert len(verdicts) == 9 and not all(verdicts.values()) and any(verdicts.values())
    before = incremental(spark, lake)
    audit.run_audit(spark, lake, HOURS)  # nothing new
    assert incremental(spark, lake) == before


def test_a_run_reads_only_new_batches_and_windows(spark):
    lake = Lake.fresh(spark, "t-audit-plan")
    for k in range(3):
        facts(spark, lake, k, (2 * k, 2 * k + 2))
        finalise(spark, lake, 2 * k + 2)
    new = audit.new_batches(lake.read(spark, "gold", "fact_rides"), 1, 2)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "(batch_id" in plan.split("PartitionFilters")[1]
    assert {r[0].rsplit("/", 2)[1] for r in new.select("_metadata.file_path").distinct().collect()} == {"batch_id=2"}
    windows = audit.new_windows(lake.read(spark, "mart", "mart_revenue_hourly"), T0 + dt.timedelta(hours=4))
    assert "PushedFilters: [IsNotNull(hour_start), GreaterThanOrEqual(hour_start" in windows._jdf.queryExecution().executedPlan().toString()
    assert windows.count() == 2


@pytest.mark.parametrize("where", ["telemetry", "runs"])
def test_a_run_that_fails_counts_nothing(spark, monkeypatch, where):
    lake = Lake.fresh(spark, "t-audit-fail")
    facts(spark, lake, 0, (0, 5), True)
    finalise(spark, lake, 4)
    audit.run_audit(spark, lake, HOURS)
    want = incremental(spark, lake)
    facts(spark, lake, 1, (5, 9))
    writer = type(spark.range(1).write)
    plain = writer.parquet

    def failing(self, path, *a, **b):
        if f"{where}/run=1" in path:
            raise RuntimeError("lost")
        return plain(self, path, *a, **b)

    monkeypatch.setattr(writer, "parquet", failing)
    with pytest.raises(RuntimeError, match="lost"):
        audit.run_audit(spark, lake, HOURS)
    assert incremental(spark, lake) == want
    monkeypatch.undo()
    finalise(spark, lake, 8)
    assert audit.run_audit(spark, lake, HOURS) == 1
    assert incremental(spark, lake) == full(spark, lake)


def test_an_empty_lake_passes(spark):
    lake = Lake.fresh(spark, "t-audit-empty")
    audit.run_audit(spark, lake, HOURS)
    report = incremental(spark, lake)
    assert len(report) == 9 and all(r[1] for r in report)
    facts(spark, lake, 0, (0, 3))
    finalise(spark, lake, 2)
    audit.run_audit(spark, lake, HOURS)
    assert incremental(spark, lake) == full(spark, lake)
