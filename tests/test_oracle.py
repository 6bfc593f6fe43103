"""Every named query against its DuckDB oracle on the driver's smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import rows_of  # noqa: E402

from velolake.plans.registry import all_oracles, all_queries  # noqa: E402
from velolake.sources.tables import DRIVER_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = [n for n in all_oracles() if not n.startswith("stream_")]
STREAM = ["stream_silver_rides_valid", "stream_dim_time_hourly", "stream_mart_fleet_health", "stream_end_to_end"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST + STREAM)
def test_query_matches_oracle(spark, duck, name):
    df = all_queries()[name](spark, SF)
    scols, srows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(all_oracles()[name])
    dcols, drows = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert len(srows) == len(drows)
    assert srows == drows


def test_every_query_has_oracle_or_is_rows_only():
    missing = set(all_queries()) - set(all_oracles())
    assert missing == {"mart_file_freshness", "mart_folder_freshness"}


def test_entry_smoke(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour_start", "hour_end", "completed_rides", "total_revenue", "avg_fare_amount",
                          "total_distance_km", "avg_distance_km", "avg_duration_mins"]
