"""Plan guards: what the physical plans of the named queries must (not) contain."""

import pytest

from velolake.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "Expand", "SortMergeJoin", "ShuffledHashJoin"]


def plan_text(df):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


# Validation queries write stored tables first; their plans are checked on the stored
# tables by test_validation_plan below.
BATCH = [n for n in REGISTRY if n not in {"validation_report", "validation_summary",
                                          "revenue_reconciliation", "fleet_bound"}]


@pytest.mark.parametrize("name", BATCH)
def test_no_joins_udfs_or_expand(spark, name):
    text = plan_text(REGISTRY[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in text, f"{name}: {op} in plan"


def test_events_scan_reads_only_needed_columns(spark):
    text = plan_text(REGISTRY["mart_fleet_health"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in text or \
        "struct<event_id:bigint,ts:timestamp_ntz,value:double>" in text


def test_exact_mart_aggregates_partially_before_each_shuffle(spark):
    text = REGISTRY["mart_revenue"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(below) == 3 and all("HashAggregate(keys=" in x for x in below)
    # the one shuffle by ride carries the pair of keys and nothing else
    (pairs,) = [x for x in below if "functions=[]" in x]
    names = [c.split("#")[0].strip() for c in pairs.split("output=[")[1].rstrip("])").split(",")]
    assert names == ["w", "ride_id"]


def test_validation_plan_uses_scalar_subqueries_not_joins(spark):
    from velolake.operators import quality
    from velolake.plans.frames import Frames, StoredTables
    t = StoredTables(Frames(spark, SF), "t-plan")
    text = plan_text(quality.validation_report(t.fact_rides, t.fact_telemetry, t.mart_revenue, t.mart_fleet))
    for op in FORBIDDEN:
        assert op not in text, op
    assert "Subquery" in text


@pytest.mark.parametrize("name", BATCH)
def test_every_key_shuffle_is_preaggregated(spark, name):
    """Each hash shuffle carries partial aggregates, never raw rows: a hot key (a third of all
    rows) leaves every task as one partial row.  The only other exchanges: round-robin
    spreading of a small source, single-partition exchanges of global aggregates / top-k, and
    the range partitioning of a time-ordered series over mart windows."""
    df = REGISTRY[name](spark, SF)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = lines[i + 1]
            assert "HashAggregate(keys=" in below, f"{name}: raw rows shuffled by key:\n{line}\n{below}"
        elif "Exchange" in line:
            assert ("RoundRobinPartitioning" in line or "SinglePartition" in line
                    or ("rangepartitioning(hour_start" in line and name.startswith("series_"))), f"{name}: {line}"
