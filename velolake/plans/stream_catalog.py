"""Streaming named queries.

Each call publishes the ``events``-derived messages into a fresh lake under the
session's shared folder, runs the needed layers as ``availableNow`` streaming
queries, and returns a batch read of the output table.  In a single increment no
row is late, so a mart holds exactly the windows whose end is at or before the final
watermark, ``max(event_ts) - delay``; newer windows stay in state until a later run
(the SQL oracles apply the same cut).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import constants as K
from velolake.plans.frames import Frames, as_ntz
from velolake.plans.oracle import BASE, FLEET, FLEET_DEFAULT, MINUTE, ORACLE as BATCH_ORACLE, REV, REV_DEFAULT, RIDE_COLS, _report, _unless_broken
from velolake.sources import sample
from velolake.streaming import layers as L
from velolake.streaming.lake import TOPICS, Lake

REGISTRY: dict = {}
ORACLE: dict[str, str] = {}


def _register(name: str, oracle: str | None = None, digits: int | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_ntz(fn(Frames(spark, sf_dir)), digits)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _cores(f: Frames) -> int:
    """State partitions for the named streams: one per core of the cluster."""
    return f.spark.sparkContext.defaultParallelism


def _published(f: Frames, label: str) -> Lake:
    lake = Lake.fresh(f.spark, label)
    L.publish(sample.messages(f.events, "rides"), lake, TOPICS["rides"])
    L.publish(sample.messages(f.events, "telemetry"), lake, TOPICS["telemetry"])
    return lake


def _through_silver(f: Frames, label: str, undecided: str = "drop") -> Lake:
    lake = _published(f, label)
    L.run_incremental(f.spark, lake, layers=("bronze", "silver"), undecided=undecided)
    return lake


def _with_batch_facts(f: Frames, label: str) -> Lake:
    """Gold facts written by a batch job, for the mart stream to consume."""
    lake = Lake.fresh(f.spark, label)
    f.fact_rides.write.parquet(lake.table("gold", "fact_rides"))
    f.fact_telemetry.write.parquet(lake.table("gold", "fact_telemetry"))
    return lake


def _cut(mart_cte: str, fact_cte: str, where: str, delay: str, columns: str = "*") -> str:
    return (f"SELECT {columns} FROM {mart_cte} WHERE hour_end <= "
            f"(SELECT max(event_ts) FROM {fact_cte}{where}) - INTERVAL {delay}")


REV_CUT = _cut("mart_revenue", "fact_rides", " WHERE event_type = 'end'", "1 MINUTE", REV)
FLEET_CUT = _cut("mart_fleet", "fact_tel", "", "1 MINUTE", FLEET)


@_register("stream_silver_rides_valid", BATCH_ORACLE["silver_rides_valid"])
def stream_silver_rides_valid(f: Frames):
    """landing -> bronze -> silver valid route, all as availableNow streams."""
    lake = _through_silver(f, "silver")
    return lake.read(f.spark, "silver", TOPICS["rides"])


@_register("stream_silver_rides_quarantine", BATCH_ORACLE["silver_rides_quarantine"])
def stream_silver_rides_quarantine(f: Frames):
    lake = _through_silver(f, "silver")
    return lake.read(f.spark, "silver_bad_data", TOPICS["rides"])


@_register("stream_silver_rides_split", BASE + f"""
    SELECT 'valid' AS route, *, CAST(NULL AS VARCHAR) AS error_message FROM silver_rides
    UNION ALL
    SELECT 'quarantine' AS route, * FROM quarantine_rides""")
def stream_silver_rides_split(f: Frames):
    """Both silver routes of one run, tagged by route: every decided row lands in exactly one."""
    lake = _through_silver(f, "silver")
    valid = lake.read(f.spark, "silver", TOPICS["rides"])
    bad = lake.read(f.spark, "silver_bad_data", TOPICS["rides"])
    return (valid.select(F.lit("valid").alias("route"), "*", F.lit(None).cast("string").alias("error_message"))
            .unionByName(bad.select(F.lit("quarantine").alias("route"), "*")))


@_register("stream_silver_telemetry_valid", BATCH_ORACLE["silver_telemetry_valid"])
def stream_silver_telemetry_valid(f: Frames):
    lake = _through_silver(f, "silver")
    return lake.read(f.spark, "silver", TOPICS["telemetry"])


@_register("stream_silver_telemetry_quarantine_with_undecided",
           BATCH_ORACLE["silver_telemetry_quarantine_with_undecided"])
def stream_silver_telemetry_quarantine_with_undecided(f: Frames):
    lake = _through_silver(f, "silver", undecided="quarantine")
    return lake.read(f.spark, "silver_bad_data", TOPICS["telemetry"])


def _gold(f: Frames, label: str, dims: str = "merge") -> Lake:
    lake = _published(f, label)
    L.run_incremental(f.spark, lake, layers=("bronze", "silver", "gold"), dims=dims, state_partitions=_cores(f))
    return lake


@_register("stream_fact_rides", BATCH_ORACLE["fact_rides"])
def stream_fact_rides(f: Frames):
    return L.read_gold(f.spark, _gold(f, "gold"), "fact_rides")


@_register("stream_fact_telemetry", BATCH_ORACLE["fact_telemetry"])
def stream_fact_telemetry(f: Frames):
    return L.read_gold(f.spark, _gold(f, "gold"), "fact_telemetry")


@_register("stream_dim_city", BATCH_ORACLE["dim_city"])
def stream_dim_city(f: Frames):
    """Dimension maintained per micro-batch (distinct keys minus earlier batches)."""
    return L.read_gold(f.spark, _gold(f, "gold"), "dim_city")


@_register("stream_dim_payment_method", BATCH_ORACLE["dim_payment_method"])
def stream_dim_payment_method(f: Frames):
    return L.read_gold(f.spark, _gold(f, "gold"), "dim_payment_method")


@_register("stream_dim_time_hourly", BATCH_ORACLE["dim_time_hourly"])
def stream_dim_time_hourly(f: Frames):
    return L.read_gold(f.spark, _gold(f, "gold"), "dim_time_hourly")


@_register("stream_dim_city_state", BATCH_ORACLE["dim_city"])
def stream_dim_city_state(f: Frames):
    """The reference operator: watermark + stateful ``dropDuplicates``."""
    return L.read_gold(f.spark, _gold(f, "gold_state", dims="state"), "dim_city")


@_register("stream_mart_revenue", BASE + REV_CUT, digits=6)
def stream_mart_revenue(f: Frames):
    """Hourly revenue mart as a stream with the 1-minute watermark (W1-W4, W7), exact counts."""
    lake = _with_batch_facts(f, "mart")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, exact=True,
                      state_partitions=_cores(f))
    return lake.read(f.spark, "mart", "mart_revenue_hourly")


@_register("stream_mart_fleet_health", BASE + FLEET_CUT, digits=6)
def stream_mart_fleet_health(f: Frames):
    lake = _with_batch_facts(f, "mart")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, exact=True,
                      state_partitions=_cores(f))
    return lake.read(f.spark, "mart", "mart_fleet_health_hourly")


@_register("stream_mart_revenue_minutely", MINUTE + REV_CUT, digits=6)
def stream_mart_revenue_minutely(f: Frames):
    """The reference's defaults: 1-minute windows under a 1-minute watermark."""
    lake = _with_batch_facts(f, "mart")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.MART_WINDOW_DURATION, exact=True,
                      state_partitions=_cores(f))
    return lake.read(f.spark, "mart", "mart_revenue_hourly")


@_register("stream_mart_revenue_reference_mode", BASE + REV_DEFAULT + f"({REV_CUT})", digits=6)
def stream_mart_revenue_reference_mode(f: Frames):
    """The default mart form as a stream (HLL ``completed_rides``), with the exact count of the
    batch plan beside it per window."""
    from velolake.operators import marts
    lake = _with_batch_facts(f, "refmode")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, state_partitions=_cores(f))
    exact = marts.revenue_mart(lake.read(f.spark, "gold", "fact_rides"), window=K.HOURLY, exact=True)
    return marts.beside_exact(lake.read(f.spark, "mart", "mart_revenue_hourly"), exact, marts.REVENUE_COUNTS)


@_register("stream_mart_fleet_health_default", BASE + FLEET_DEFAULT + f"({FLEET_CUT}))", digits=6)
def stream_mart_fleet_health_default(f: Frames):
    """The default fleet mart as a stream (four HLL counts), with the exact counts beside it."""
    from velolake.operators import marts
    lake = _with_batch_facts(f, "fleetmode")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, state_partitions=_cores(f))
    exact = marts.fleet_mart(lake.read(f.spark, "gold", "fact_telemetry"), window=K.HOURLY, exact=True)
    return marts.beside_exact(lake.read(f.spark, "mart", "mart_fleet_health_hourly"), exact, marts.FLEET_COUNTS)


@_register("stream_end_to_end", BASE + REV_CUT, digits=6)
def stream_end_to_end(f: Frames):
    """landing -> bronze -> silver -> gold -> mart, every layer a stream."""
    lake = _published(f, "e2e")
    L.run_incremental(f.spark, lake, window=K.HOURLY, exact=True, state_partitions=_cores(f))
    return lake.read(f.spark, "mart", "mart_revenue_hourly")


@_register("stream_late_rows", BASE + REV_CUT, digits=6)
def stream_late_rows(f: Frames):
    """Facts in two increments; the second holds rows of a window that is still open, which
    count, and copies of the first one's rows under other ids, whose windows have closed (W4)."""
    lake = Lake.fresh(f.spark, "late")
    facts = f.fact_rides
    middle = facts.agg(F.timestamp_seconds((F.min(F.unix_timestamp("event_ts")) + F.max(F.unix_timestamp("event_ts"))) / 2)).scalar()
    first = facts.where(F.col("event_ts") <= middle)
    # closed by the first increment: windows that end before its last completed ride, less the delay
    last = first.where("event_type = 'end'").agg(F.max("event_ts")).scalar()
    closed = first.where(F.date_trunc("hour", "event_ts") + F.expr("INTERVAL 1 HOUR") <= last - F.expr("INTERVAL 1 MINUTE"))
    late = closed.withColumn("ride_id", F.concat(F.lit("late-"), "ride_id"))
    first.write.parquet(lake.table("gold", "fact_rides"))
    f.fact_telemetry.limit(0).write.parquet(lake.table("gold", "fact_telemetry"))
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, exact=True, state_partitions=_cores(f))
    facts.where(F.col("event_ts") > middle).union(late).write.mode("append").parquet(lake.table("gold", "fact_rides"))
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, exact=True, state_partitions=_cores(f))
    return lake.read(f.spark, "mart", "mart_revenue_hourly")


@_register("stream_resume", BATCH_ORACLE["silver_rides_valid"])
def stream_resume(f: Frames):
    """Two increments of messages, and a third without any: each run resumes from its
    checkpoint, and every message is in the table once (W6)."""
    lake = Lake.fresh(f.spark, "resume")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1, F.lit(False)):
        L.publish(sample.messages(f.events.where(part), "rides"), lake, TOPICS["rides"])
        L.publish(sample.messages(f.events.where(part), "telemetry"), lake, TOPICS["telemetry"])
        L.run_incremental(f.spark, lake, layers=("bronze", "silver"))
    return lake.read(f.spark, "silver", TOPICS["rides"])


@_register("stream_schema_evolution", BASE + """
    SELECT * EXCLUDE n, CASE WHEN n % 3 = 1 THEN 'P-' || CAST(n % 10 AS VARCHAR) END AS promo_code
    FROM (SELECT *, CAST(substr(ride_id, 3) AS BIGINT) AS n FROM fact_rides)""")
def stream_schema_evolution(f: Frames):
    """Three increments of rides through silver and gold; the messages of the second, and its
    plan, have one more field.  The facts have it as a column, NULL before and after (S8)."""
    from velolake import schemas
    lake = Lake.fresh(f.spark, "evolution")
    grown = schemas.StructType([*schemas.RIDE_PAYLOAD, schemas.StructField("promo_code", schemas.StringType())])
    promo = F.concat(F.lit("P-"), (F.col("event_id") % 10).cast("string"))
    for k in range(3):
        part = f.events.where(F.col("event_id") % 3 == k)
        L.publish(sample.messages(part, "rides", {"promo_code": promo} if k == 1 else None), lake, TOPICS["rides"])
        if not k:  # the telemetry topic stays as it is
            L.publish(sample.messages(f.events, "telemetry"), lake, TOPICS["telemetry"])
        L.run_layer(L.start_bronze(f.spark, lake))
        L.run_layer(L.start_silver(f.spark, lake, payloads={"rides": grown} if k == 1 else None))
        L.run_layer(L.start_gold(f.spark, lake, tables=("fact_rides",)))
    return L.read_gold(f.spark, lake, "fact_rides")


def _one_read(f: Frames) -> Lake:
    """Two increments through silver, and gold with one read of it a topic."""
    lake = Lake.fresh(f.spark, "oneread")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        for kind, topic in TOPICS.items():
            L.publish(sample.messages(f.events.where(part), kind), lake, topic)
        L.run_incremental(f.spark, lake, layers=("bronze", "silver", "gold"), one_read=True)
    return lake


@_register("stream_facts_one_read", BASE + """
    SELECT 'rides' AS topic, ride_id, scooter_id, event_ts, city, fare_amount, battery_level FROM
      (SELECT *, CAST(NULL AS BIGINT) AS battery_level FROM fact_rides)
    UNION ALL
    SELECT 'telemetry', NULL, scooter_id, event_ts, NULL, NULL, battery_level FROM fact_tel""")
def stream_facts_one_read(f: Frames):
    """Both fact tables as the two one-read queries write them."""
    lake = _one_read(f)
    names = ["ride_id", "scooter_id", "event_ts", "city", "fare_amount", "battery_level"]
    rides, telemetry = (L.read_gold(f.spark, lake, t) for t in ("fact_rides", "fact_telemetry"))
    both = rides.select(F.lit("rides").alias("topic"), *[c for c in names if c in rides.columns]).unionByName(
        telemetry.select(F.lit("telemetry").alias("topic"), *[c for c in names if c in telemetry.columns]), allowMissingColumns=True)
    return both.select("topic", *names)


@_register("stream_dims_one_read", BASE + """
    SELECT 'city' AS dimension, city AS key, CAST(NULL AS TIMESTAMP) AS hour_start, CAST(NULL AS INTEGER) AS day_of_week
    FROM (SELECT DISTINCT city FROM fact_rides WHERE city IS NOT NULL)
    UNION ALL SELECT 'payment_method', payment_method, NULL, NULL FROM (SELECT DISTINCT payment_method FROM fact_rides WHERE payment_method IS NOT NULL)
    UNION ALL SELECT 'time_hourly', NULL, h, CAST(dayofweek(h) + 1 AS INTEGER) FROM
      (SELECT DISTINCT date_trunc('hour', event_ts) AS h FROM (SELECT event_ts FROM fact_rides UNION ALL SELECT event_ts FROM fact_tel))""")
def stream_dims_one_read(f: Frames):
    """The three dimensions as the two one-read queries maintain them."""
    lake = _one_read(f)
    hours = L.read_gold(f.spark, lake, "dim_time_hourly").select(
        F.lit("time_hourly").alias("dimension"), F.lit(None).cast("string").alias("key"), "hour_start", "day_of_week")
    for t in ("city", "payment_method"):
        hours = hours.unionByName(L.read_gold(f.spark, lake, f"dim_{t}").select(F.lit(t).alias("dimension"), F.col(t).alias("key")),
                                  allowMissingColumns=True)
    return hours


@_register("stream_mart_rollup", MINUTE + """
    SELECT date_trunc('hour', event_ts) AS hour_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS hour_end,
           count(DISTINCT ride_id) AS completed_rides, true AS completed_rides_within_bound,
           round(sum(fare_amount), 6) AS total_revenue, round(avg(fare_amount), 6) AS avg_fare_amount
    FROM fact_rides WHERE event_type = 'end' AND date_trunc('minute', event_ts) + INTERVAL 1 MINUTE <=
      (SELECT max(event_ts) FROM fact_rides WHERE event_type = 'end') - INTERVAL 1 MINUTE
    GROUP BY 1, 2""", digits=6)
def stream_mart_rollup(f: Frames):
    """Minute sketches as a stream under the 1-minute watermark, their closed windows rolled up to
    hours, the exact count of the same rows beside the estimate (A5, W1-W3)."""
    from velolake.operators import marts, sketches
    lake = _with_batch_facts(f, "sketchstream")
    L.run_layer(L.start_sketch_marts(f.spark, lake, state_partitions=_cores(f)))
    minutes = lake.read(f.spark, "mart", "mart_revenue_sketch")
    hours = sketches.estimates(sketches.rollup(minutes, K.HOURLY))
    closed = lake.read(f.spark, "gold", "fact_rides").where(
        F.date_trunc("minute", "event_ts") <= minutes.agg(F.max("hour_start")).scalar())
    exact = marts.revenue_mart(closed, window=K.HOURLY, exact=True)
    return marts.beside_exact(hours, exact, sketches.REVENUE_SKETCHES, sketches.BOUND).select(
        "hour_start", "hour_end", "completed_rides", "completed_rides_within_bound", "total_revenue", "avg_fare_amount")


SLOTS = 100  # stretches of time that arrive one after the other

@_register("stream_late_ledger", BASE + f"""
    , e AS (SELECT event_ts, epoch(event_ts)::BIGINT AS s, CAST(substr(ride_id, 3) AS BIGINT) AS n FROM fact_rides WHERE event_type = 'end'),
    b AS (SELECT event_ts, ((s - min(s) OVER ()) * {SLOTS}) // (max(s) OVER () - min(s) OVER () + 1) + CASE WHEN n % 10 = 3 THEN 2 ELSE 0 END AS slot FROM e),
    m AS (SELECT slot, max(event_ts) AS newest, dense_rank() OVER (ORDER BY slot) - 1 AS batch_id FROM b GROUP BY slot),
    w AS (SELECT slot, batch_id, max(newest) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 MINUTE AS watermark FROM m)
    SELECT batch_id, count(*) AS rows, count(*) FILTER (WHERE date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= watermark) AS late_rows,
           any_value(watermark) AS watermark
    FROM b JOIN w USING (slot) GROUP BY batch_id""")
def stream_late_ledger(f: Frames):
    """Completed rides that arrive stretch by stretch, a tenth of them two stretches late, counted
    batch by batch in over a hundred runs of one stream: rows, watermark, late rows (W4, W6)."""
    from velolake.operators import marts
    from velolake.streaming import ledger
    lake = Lake.fresh(f.spark, "ledger")
    ends = marts.revenue_base(f.fact_rides)
    s, n = F.unix_timestamp("event_ts"), F.substring("ride_id", 3, 20).cast("long")
    bounds = ends.agg(F.struct(F.min(s).alias("lo"), F.max(s).alias("hi"))).scalar()
    slot = F.floor((s - bounds["lo"]) * SLOTS / (bounds["hi"] - bounds["lo"] + 1)) + F.when(n % 10 == 3, 2).otherwise(0)
    stage, path = lake.table("gold", "staged"), lake.table("ledger", "late_rows")
    ends.withColumn("slot", slot.cast("int")).write.partitionBy("slot").parquet(stage)
    staged = f.spark.read.parquet(stage)
    for (k,) in sorted(staged.select("slot").distinct().collect()):  # at most SLOTS + 2
        staged.where(F.col("slot") == k).drop("slot").write.mode("append").parquet(lake.table("gold", "fact_rides"))
        rides = marts.revenue_base(lake.read_stream(f.spark, "gold", "fact_rides"))
        L.run_layer([ledger.start_late_ledger(rides, path, lake.checkpoint("ledger", "late_rows"), K.HOURLY)])
    return ledger.read_late(f.spark, path).select("batch_id", "rows", "late_rows", "watermark")


def _dims_in_two_runs(f: Frames, label: str, dims: str, tables: tuple[str, ...]) -> Lake:
    """Dimensions from silver rides in two runs: the newer half first, so that the second run's
    rows are all older than the first one's, many behind the watermark."""
    lake = Lake.fresh(f.spark, label)
    ts = F.col("timestamp")
    middle = f.silver_rides.agg((F.min(ts) + F.max(ts)) / 2).scalar()
    f.silver_telemetry.write.parquet(lake.table("silver", TOPICS["telemetry"]))
    for newer in (True, False):
        rows = f.silver_rides.where(ts > middle if newer else (ts <= middle) | ts.isNull())
        rows.write.mode("append").parquet(lake.table("silver", TOPICS["rides"]))
        L.run_layer(L.start_gold(f.spark, lake, tables=tables, dims=dims, state_partitions=_cores(f)))
    return lake


@_register("stream_dedup_state_rows", BASE + """
    SELECT city, CAST(1 AS BIGINT) AS state_partitions, true AS in_table, true AS kept_from_first_run
    FROM (SELECT DISTINCT city FROM fact_rides WHERE city IS NOT NULL)""")
def stream_dedup_state_rows(f: Frames):
    """The state of the stateful city dedup as a table, after a second run of rows that are far
    behind the watermark: every city of the facts is in it, in one partition, and in the dimension,
    and none that the first run left in it has gone, as nothing expires (W5, W6)."""
    from velolake.streaming import state
    lake = _dims_in_two_runs(f, "staterows", "state", ("dim_city",))
    checkpoint = lake.checkpoint("gold", "dim_city_state")
    operator = state.state_operators(f.spark, checkpoint)
    first = state.dedup_keys(f.spark, checkpoint, "city", batch_id=0).select("city", F.lit(1).alias("early"))
    now = state.dedup_keys(f.spark, checkpoint, "city").withColumn("now", F.lit(1))
    table = L.read_gold(f.spark, lake, "dim_city").select("city", F.lit(1).alias("stored"))
    rows = now.unionByName(first, allowMissingColumns=True).unionByName(table, allowMissingColumns=True).groupBy("city").agg(
        F.max("state_partitions").alias("state_partitions"), F.count("stored").alias("stored"), F.count("now").alias("now"),
        F.count("early").alias("early"))
    kept = (F.col("now") >= F.col("early")) & (operator.agg(F.max("maxBatchId")).scalar() >= 1)
    return rows.select("city", "state_partitions", (F.col("stored") == 1).alias("in_table"), kept.alias("kept_from_first_run"))


@_register("stream_dim_payment_method_salted", BATCH_ORACLE["dim_payment_method"])
def stream_dim_payment_method_salted(f: Frames):
    """Three payment methods carry every row: two chained stateful dedups, the first by (key,
    salt), in two runs (U3, W5)."""
    lake = _dims_in_two_runs(f, "salted", "salted", ("dim_payment_method",))
    return L.read_gold(f.spark, lake, "dim_payment_method")


def _in_three_increments(f: Frames, label: str) -> Lake:
    """All layers in three increments of messages by arrival, each followed by an audit run."""
    from velolake.streaming import audit
    lake = Lake.fresh(f.spark, label)
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    bounds = f.events.agg(F.struct(F.min(second).alias("lo"), F.max(second).alias("hi"))).scalar()
    third = F.floor((second - bounds["lo"]) * 3 / (bounds["hi"] - bounds["lo"] + 1))
    for k in range(3):
        for kind, topic in TOPICS.items():
            L.publish(sample.messages(f.events.where(third == k), kind), lake, topic)
        L.run_incremental(f.spark, lake, window=K.HOURLY, exact=True, one_read=True, state_partitions=_cores(f))
        audit.run_audit(f.spark, lake, K.HOURLY)
    return lake


@_register("stream_incremental_report", BASE + f", rev_cut AS ({REV_CUT}), fleet_cut AS ({FLEET_CUT})"
           + _report(revenue="rev_cut", fleet="fleet_cut") + "SELECT * FROM report")
def stream_incremental_report(f: Frames):
    """The nine checks after three increments, each audited by itself: figures of the ledger, not of
    the tables (V3, V5, V16)."""
    from velolake.streaming import audit
    return audit.audit_report(f.spark, _in_three_increments(f, "audit"))


@_register("stream_start_and_loss", BASE + f"""
    SELECT bronze_ingestion_time, {_unless_broken(RIDE_COLS.replace('"', '').removeprefix("bronze_ingestion_time, "))}
    FROM rides_sent WHERE event_id % 4 IN (1, 2)""")
def stream_start_and_loss(f: Frames):
    """Four lots of messages: the first is there before the stream's first start, which begins at
    the latest, and the last one's files have gone when their turn comes (S1)."""
    from velolake.operators import silver
    from velolake.sources.envelope import read_landing
    from velolake.streaming.sinks import batch_sink
    lake = Lake.fresh(f.spark, "start")
    landing, out = lake.landing(TOPICS["rides"]), lake.table("bronze", TOPICS["rides"])

    def publish(k: int) -> set[str]:
        before = files() if k else set()
        L.publish(sample.messages(f.events.where(F.col("event_id") % 4 == k), "rides"), lake, TOPICS["rides"])
        return files() - before

    def files() -> set[str]:
        return {r[0] for r in f.spark.read.format("binaryFile").load(f"{landing}/*.parquet").select("path").collect()}

    def run(gone: set[str]) -> None:
        def write(batch_df: DataFrame, batch_id: int) -> None:
            for path in gone:  # listed with this run's other files, gone before their batch
                p = f.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(f.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
            batch_df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        messages = read_landing(f.spark, landing, 1, "latest", f"{lake.root}/bronze/starts/rides", fail_on_data_loss=False)
        L.run_layer([batch_sink(messages, write, lake.checkpoint("bronze", "rides"))])

    publish(0)
    run(set())
    publish(1)
    run(set())
    publish(2)
    run(publish(3))
    return silver.parse_rides(lake.read(f.spark, "bronze", TOPICS["rides"]))


@_register("stream_bronze_continuous", BATCH_ORACLE["bronze_parse_rides"])
def stream_bronze_continuous(f: Frames):
    """Continuous ingest (S4) until one of its queries stops, which ends the layer."""
    from velolake.operators import silver
    from velolake.streaming.sinks import run_layer
    lake = _published(f, "continuous")
    queries = L.start_bronze(f.spark, lake, trigger="continuous")
    for q in queries:
        q.processAllAvailable()
    queries[-1].stop()
    run_layer(queries, wait="any", timeout_s=600)
    return silver.parse_rides(lake.read(f.spark, "bronze", TOPICS["rides"]))


@_register("folder_scan", BASE + "SELECT * FROM fact_rides UNION ALL SELECT * FROM fact_rides")
def folder_scan(f: Frames):
    """Every file of a stream's table folder, also one its log does not list."""
    from velolake import schemas
    from velolake.sources.tables import read_folder
    lake = _with_batch_facts(f, "folder")
    out = lake.table("gold", "copy")
    L.run_layer([L.append_sink(lake.read_stream(f.spark, "gold", "fact_rides"), out, lake.checkpoint("gold", "copy"))])
    f.fact_rides.write.mode("append").parquet(out)
    return read_folder(f.spark, out, schemas.FACT_RIDES)


@_register("mart_folder_listing", BASE + """
    SELECT 'mart_revenue_hourly' AS "table", CAST(3 AS BIGINT) AS files, true AS has_time
    UNION ALL SELECT 'not there', 0, false""")
def mart_folder_listing(f: Frames):
    """The file card of a mart written as three files, and of a folder that is not there."""
    from velolake.sources.tables import folder_inventory
    lake = Lake.fresh(f.spark, "listing")
    f.mart_revenue.repartition(3).write.parquet(lake.table("mart", "mart_revenue_hourly"))

    def card(path: str, name: str) -> DataFrame:
        return folder_inventory(f.spark, path).select(
            F.lit(name).alias("table"), "files", F.col("latest_file_time").isNotNull().alias("has_time"))

    return card(lake.table("mart", "mart_revenue_hourly"), "mart_revenue_hourly").union(
        card(lake.table("mart", "nothing"), "not there"))


@_register("mart_file_freshness")
def mart_file_freshness(f: Frames):
    """Data files and newest file time of both marts as written by a stream.
    Rows-only: file times are not reproducible."""
    from velolake.sources.tables import file_inventory
    lake = _with_batch_facts(f, "fresh")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, exact=True,
                      state_partitions=_cores(f))
    rev = file_inventory(lake.read(f.spark, "mart", "mart_revenue_hourly"))
    fleet = file_inventory(lake.read(f.spark, "mart", "mart_fleet_health_hourly"))
    return (rev.select(F.lit("mart_revenue_hourly").alias("table"), "*")
            .unionByName(fleet.select(F.lit("mart_fleet_health_hourly").alias("table"), "*")))


@_register("mart_folder_freshness")
def mart_folder_freshness(f: Frames):
    """The dashboard's file cards: every ``*.parquet`` file in each mart folder, newest file
    time and its text label (B7 as a plain listing).  Rows-only: file times vary."""
    from velolake.sources.tables import folder_inventory
    lake = _with_batch_facts(f, "folder")
    L.run_incremental(f.spark, lake, layers=("mart",), window=K.HOURLY, exact=True,
                      state_partitions=_cores(f))
    rev = folder_inventory(f.spark, lake.table("mart", "mart_revenue_hourly"))
    fleet = folder_inventory(f.spark, lake.table("mart", "mart_fleet_health_hourly"))
    return (rev.select(F.lit("mart_revenue_hourly").alias("table"), "*")
            .unionByName(fleet.select(F.lit("mart_fleet_health_hourly").alias("table"), "*")))
