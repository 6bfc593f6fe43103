import datetime as dt

from velolake import schemas
from velolake.operators import reports

H = [dt.datetime(2024, 1, 1, h) for h in range(12)]


def test_last_n_puts_null_times_last_in_ascending_order(spark):
    rows = [(h, h, 1, 1.0, 1.0, 1.0, 1.0, 1.0) for h in H] + [(None, None, 1, 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, schemas.MART_REVENUE)
    got = [r.hour_start for r in reports.last_n(df, 3).collect()]
    assert got == [H[10], H[11], None]
    assert [r.hour_start for r in reports.latest_windows(df, 2).collect()] == [H[11], H[10]]


def test_kpis_treat_null_as_zero_and_missing_columns_as_empty(spark):
    rows = [(H[0], H[1], 2, 10.25, 5.0, 1.0, 1.0, 1.0), (H[1], H[2], None, None, None, None, None, None)]
    k = reports.kpi_revenue(spark.createDataFrame(rows, schemas.MART_REVENUE)).first()
    assert (k.total_revenue, k.completed_rides) == (10.25, 2)
    fleet = spark.createDataFrame([(H[0], H[1], 3, 40.0, 1, 1, 2), (H[1], H[2], 1, None, None, 0, 0)],
                                  schemas.MART_FLEET)
    kf = reports.kpi_fleet(fleet).first()
    assert (kf.avg_battery_level, kf.low_battery_scooters, kf.scooters_in_maintenance) == (20.0, 1, 2)
    partial = spark.createDataFrame([(H[0], 7.5)], "hour_start timestamp, total_revenue double")
    kp = reports.kpi_revenue(partial).first()
    assert (kp.total_revenue, kp.completed_rides) == (7.5, 0)
    none = reports.kpi_fleet(partial).first()
    assert (none.avg_battery_level, none.low_battery_scooters, none.scooters_in_maintenance) == (None, 0, 0)
    assert reports.series(partial, "avg_battery_level").collect() == []


def test_series_drops_nulls_and_orders(spark):
    rows = [(H[2], H[3], 1, 3.0, 1.0, 1.0, 1.0, 1.0), (H[0], H[1], 1, None, 1.0, 1.0, 1.0, 1.0),
            (H[1], H[2], 1, 2.0, 1.0, 1.0, 1.0, 1.0)]
    s = reports.series(spark.createDataFrame(rows, schemas.MART_REVENUE), "total_revenue").collect()
    assert [(r.hour_start, r.total_revenue) for r in s] == [(H[1], 2.0), (H[2], 3.0)]


def test_text_times_are_coerced_leniently(spark):
    df = spark.createDataFrame([("2024-01-01 02:00:00", 2.0), ("garbage", 9.0), ("2024-01-01 01:00:00", 1.0),
                                ("01/02/2024 03:04", 3.0), ("20240103", 4.0), (None, 8.0)],
                               "hour_start string, total_revenue double")
    s = reports.series(df, "total_revenue").collect()
    assert [r.total_revenue for r in s] == [1.0, 2.0, 3.0, 4.0]
    last = reports.last_n(df, 1).collect()
    assert last[0].hour_start is None                 # unparseable time sorts last, so it is the last row
