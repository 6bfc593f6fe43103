"""Validation checks: each of the nine seen to pass and to fail; empty marts."""

import datetime as dt

from velolake import schemas
from velolake.operators import quality

TS = dt.datetime(2024, 1, 1, 0, 30)
H0, H1 = dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 1, 0)


def ride(rid="R-1", fare=10.0, dist=2.0, user=1, event_type="end"):
    return (rid, TS, TS, user, "S-1", event_type, "completed", "paris", "card", dist, 5, fare)


def tel(sid="S-1", batt=50, status="in_use"):
    return (TS, TS, sid, 1.0, 1.0, batt, 5.0, 10.0, 20.0, 3, False, status)


def rev(n=1, revenue=10.0, start=H0):
    return (start, H1, n, revenue, revenue, 2.0, 2.0, 5.0)


def fleet(size=1, avg=50.0, start=H0):
    return (start, H1, size, avg, 0, 1, 0)


def report(spark, rides, tels, revs, fleets):
    out = quality.validation_report(
        spark.createDataFrame(rides, schemas.FACT_RIDES), spark.createDataFrame(tels, schemas.FACT_TELEMETRY),
        spark.createDataFrame(revs, schemas.MART_REVENUE), spark.createDataFrame(fleets, schemas.MART_FLEET))
    return {r.check: r.passed for r in out.collect()}


def test_all_checks_pass_on_clean_tables(spark):
    got = report(spark, [ride()], [tel()], [rev()], [fleet()])
    assert len(got) == 9 and all(got.values())


def test_each_check_fails(spark):
    got = report(
        spark,
        [ride("R-1"), ride(None, fare=-1.0, dist=-1.0), ride("R-3")],       # null id, negative fare / distance
        [tel(batt=150), tel("S-2", batt=None)],                              # invalid battery, null battery
        [rev(n=1), rev(n=None, start=None)],                                 # mart says 1, facts say 3; NULLs
        [fleet(size=5), fleet(size=None, avg=None)])                         # 5 > 2 distinct scooters; NULLs
    assert len(got) == 9
    assert not any(got.values()), got


def test_empty_marts_pass_count_and_bound_checks(spark):
    got = report(spark, [ride()], [tel()], [], [])
    assert got["Revenue count within tolerance"] is True
    assert got["Fleet max within bounds"] is True


def test_reconciliation_values(spark):
    rides = [ride(f"R-{i}") for i in range(20)] + [ride("X", event_type="start")]
    out = quality.revenue_reconciliation(spark.createDataFrame(rides, schemas.FACT_RIDES),
                                         spark.createDataFrame([rev(n=19)], schemas.MART_REVENUE)).first()
    assert (out.fact_completed_rides, out.mart_completed_rides, out.diff) == (20, 19, 1)
    assert out.diff_pct == 5.0 and out.within_tolerance is True
    zero = quality.revenue_reconciliation(spark.createDataFrame([], schemas.FACT_RIDES),
                                          spark.createDataFrame([rev(n=3)], schemas.MART_REVENUE)).first()
    assert zero.diff_pct == 0.0 and zero.within_tolerance is True    # no fact rows: pass


def test_sums_keep_every_decimal(spark):
    from velolake.operators import marts, reports
    rows = [ride(f"r{k}", fare=2.004) for k in range(100)] + [ride("big", fare=1e15)]
    for exact in (True, False):
        m = marts.revenue_mart(spark.createDataFrame(rows[:100], schemas.FACT_RIDES), window="1 hour", exact=exact).first()
        assert round(m.total_revenue, 9) == 200.4 and round(m.avg_fare_amount, 9) == 2.004
        m = marts.revenue_mart(spark.createDataFrame(rows, schemas.FACT_RIDES), window="1 hour", exact=exact).first()
        assert abs(m.total_revenue - 1e15 - 200.4) < 0.5
    tiny = spark.createDataFrame([rev(revenue=0.004)] * 10, schemas.MART_REVENUE)
    assert round(reports.kpi_revenue(tiny).first().total_revenue, 9) == 0.04
    assert round(quality.revenue_totals(tiny).first().total_revenue, 9) == 0.04


def test_faulty_tables_fail_every_check(spark):
    from velolake.plans.catalog import REGISTRY
    rows = REGISTRY["validation_report_faulty"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 9 and not any(r.passed for r in rows)


def test_validation_needs_its_tables(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    from velolake.__main__ import main
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        main(["validate", "--lake", str(tmp_path / "nothing")])


def test_exact_totals_survive_nan_infinite_and_huge_fares(spark):
    """Fares have no upper bound and NaN / infinity pass ">= 0": exact mode must not fail."""
    import math
    from velolake.operators import marts, reports
    rows = [ride("a", fare=10.0), ride("b", fare=float("inf")), ride("c", fare=1e300)]
    m = marts.revenue_mart(spark.createDataFrame(rows, schemas.FACT_RIDES), window="1 hour", exact=True).first()
    assert m.completed_rides == 3 and math.isinf(m.total_revenue)
    nan = marts.revenue_mart(spark.createDataFrame([ride("d", fare=float("nan"))], schemas.FACT_RIDES),
                             window="1 hour", exact=True).first()
    assert math.isnan(nan.total_revenue)
    ok = marts.revenue_mart(spark.createDataFrame([ride("e", fare=1.25), ride("f", fare=2.5)], schemas.FACT_RIDES),
                            window="1 hour", exact=True).first()
    assert (ok.total_revenue, ok.avg_fare_amount) == (3.75, 1.875)
    k = reports.kpi_revenue(spark.createDataFrame([rev(revenue=float("inf")), rev(revenue=1.0)],
                                                  schemas.MART_REVENUE)).first()
    assert math.isinf(k.total_revenue)
    t = quality.revenue_totals(spark.createDataFrame([rev(revenue=1e300)], schemas.MART_REVENUE)).first()
    assert t.total_revenue == 1e300
