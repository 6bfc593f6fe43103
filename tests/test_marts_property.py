"""Exact marts vs a brute-force Python computation on random fact rows."""

import datetime as dt
import math
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from velolake import schemas
from velolake.operators import marts

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))

ts = st.integers(0, 3 * 3600 - 1).map(lambda s: T0 + dt.timedelta(seconds=s))
cents = st.integers(0, 50000).map(lambda c: c / 100)

TEL = st.tuples(ts, st.sampled_from(["S-1", "S-2", "S-3", "S-4", None]),
                st.one_of(st.none(), st.integers(0, 100)),
                st.sampled_from(["available", "in_use", "charging", "maintenance", None]))
RIDE = st.tuples(ts, st.sampled_from([f"R-{i}" for i in range(8)]), st.sampled_from(["start", "end"]),
                 st.one_of(st.none(), cents), st.one_of(st.none(), cents), st.one_of(st.none(), st.integers(0, 180)))


def hour(t):
    return t.replace(minute=0, second=0, microsecond=0)


@SETTINGS
@given(st.lists(TEL, min_size=1, max_size=120))
def test_fleet_mart_exact_matches_brute_force(spark, rows):
    facts = [(t, t, sid, 0.0, 0.0, b, 1.0, 1.0, 1.0, 3, False, status) for t, sid, b, status in rows]
    got = {r.hour_start: r for r in marts.fleet_mart(spark.createDataFrame(facts, schemas.FACT_TELEMETRY),
                                                     window="1 hour", exact=True).collect()}
    want = defaultdict(lambda: dict(fleet=set(), batt=[], low=set(), use=set(), maint=set()))
    for t, sid, b, status in rows:
        w = want[hour(t)]
        if sid is not None:
            w["fleet"].add(sid)
            if b is not None and b < 20:
                w["low"].add(sid)
            if status == "in_use":
                w["use"].add(sid)
            if status == "maintenance":
                w["maint"].add(sid)
        if b is not None:
            w["batt"].append(b)
    assert set(got) == set(want)
    for h, w in want.items():
        r = got[h]
        assert r.hour_end == h + dt.timedelta(hours=1)
        assert (r.fleet_size_seen, r.low_battery_scooters, r.scooters_in_use, r.scooters_in_maintenance) == \
            (len(w["fleet"]), len(w["low"]), len(w["use"]), len(w["maint"]))
        assert r.avg_battery_level == (sum(w["batt"]) / len(w["batt"]) if w["batt"] else None)


@SETTINGS
@given(st.lists(RIDE, min_size=1, max_size=120))
def test_revenue_mart_exact_matches_brute_force(spark, rows):
    facts = [(rid, t, t, 1, "S-1", et, "completed", "paris", "card", dist, dur, fare)
             for t, rid, et, fare, dist, dur in rows]
    got = {r.hour_start: r for r in marts.revenue_mart(spark.createDataFrame(facts, schemas.FACT_RIDES),
                                                       window="1 hour", exact=True).collect()}
    want = defaultdict(lambda: dict(rides=set(), fare=[], dist=[], dur=[]))
    for t, rid, et, fare, dist, dur in rows:
        if et != "end":
            continue
        w = want[hour(t)]
        w["rides"].add(rid)
        for k, v in (("fare", fare), ("dist", dist), ("dur", dur)):
            if v is not None:
                w[k].append(v)

    def total(vals):
        return pytest.approx(math.fsum(vals), rel=1e-12, abs=1e-12) if vals else None

    def mean(vals):
        return pytest.approx(math.fsum(vals) / len(vals), rel=1e-12, abs=1e-12) if vals else None

    assert set(got) == set(want)
    for h, w in want.items():
        r = got[h]
        assert r.completed_rides == len(w["rides"])
        assert r.total_revenue == total(w["fare"])
        assert r.avg_fare_amount == mean(w["fare"])
        assert r.total_distance_km == total(w["dist"])
        assert r.avg_duration_mins == mean(w["dur"])
