"""The four streaming layers as startable query sets.

Each ``start_*`` builds its plans from the shared operators and starts one append
query per output table, each with its own checkpoint, and returns the queries; wait
on them with :func:`velolake.streaming.sinks.run_layer`.  Layers hand over through
tables, so each can run on its own schedule (Bronze continuously, the others as
``availableNow`` increments that resume from their checkpoints).

Scale notes: silver and facts are map-only; the marts are streaming aggregations with
partial aggregation before the state shuffle; dimensions are de-duplicated per batch
before anything is shuffled (see :mod:`velolake.streaming.dims`).  The state-store
partition count is fixed by ``spark.sql.shuffle.partitions`` at a checkpoint's first
run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from velolake import constants as K
from velolake import schemas
from velolake.operators import gold, marts, silver, sketches
from velolake.sources.envelope import read_landing
from velolake.streaming import dims as D
from velolake.streaming.evolution import conform
from velolake.streaming.lake import TOPICS, Lake
from velolake.streaming.sinks import append_sink, batch_sink, run_layer

DAY_FILES = 4  # files a day in one batch of date-partitioned facts
GOLD_TABLES = ("fact_rides", "fact_telemetry", "dim_payment_method", "dim_city", "dim_time_hourly")


def publish(messages: DataFrame, lake: Lake, topic: str) -> None:
    """Producer side: append a batch of envelope messages to a topic's landing folder."""
    messages.write.mode("append").parquet(lake.landing(topic))


def start_bronze(spark: SparkSession, lake: Lake, trigger: str = "available_now",
                 sources: dict[str, DataFrame] | None = None, max_files_per_trigger: int | None = None,
                 starting: str = "earliest", fail_on_data_loss: bool = True) -> list[StreamingQuery]:
    """Envelope stream -> ``bronze/<topic>`` (raw_json, kafka_timestamp).

    ``sources`` maps ``rides`` / ``telemetry`` to streams already in bronze shape
    (``raw_json``, ``kafka_timestamp``), e.g. :func:`velolake.sources.envelope.read_topic` or
    :func:`velolake.sources.envelope.read_json_lines`; by default the landing folders are
    read, with ``starting`` and ``fail_on_data_loss`` as
    :func:`velolake.sources.envelope.read_landing` takes them.
    """
    out = []
    for kind, topic in TOPICS.items():
        src = sources[kind] if sources else read_landing(
            spark, lake.landing(topic), max_files_per_trigger, starting, f"{lake.root}/bronze/starts/{topic}", fail_on_data_loss)
        out.append(append_sink(src, lake.table("bronze", topic), lake.checkpoint("bronze", topic), trigger))
    return out


def start_silver(spark: SparkSession, lake: Lake, undecided: str = "drop", trigger: str = "available_now",
                 max_files_per_trigger: int | None = None,
                 payloads: dict[str, StructType] | None = None) -> list[StreamingQuery]:
    """bronze -> parse -> rules -> ``silver/<t>``, one query and one parse a topic; the valid
    and the quarantine route are folders of that table, which its readers prune on.

    ``payloads`` gives the message fields of ``rides`` or ``telemetry`` where they have grown.
    From that start on the table has them (S8), whether or not a later start names them again."""
    jobs = [
        ("rides", silver.parse_rides, silver.ride_rules, schemas.RIDE_PAYLOAD),
        ("telemetry", silver.parse_telemetry, silver.telemetry_rules, schemas.TELEMETRY_PAYLOAD),
    ]
    out = []
    for kind, parse, rules, payload in jobs:
        table = TOPICS[kind]
        planned = (payloads or {}).get(kind, payload)
        columns = lake.evolve(spark, "silver", table, planned)
        validated = silver.apply_rules_to(parse(
            lake.read_stream(spark, "bronze", table, max_files_per_trigger), StructType(columns.fields[1:])), rules())
        out.append(append_sink(silver.routed(validated, rules(), undecided), lake.table("silver", table),
                               lake.checkpoint("silver", table), trigger, partition_by=["route"]))
    return out


FACT_SOURCES = {"fact_rides": (TOPICS["rides"], gold.FACT_RIDES_COLUMNS),
                "fact_telemetry": (TOPICS["telemetry"], gold.FACT_TELEMETRY_COLUMNS)}


def evolved_facts(spark: SparkSession, lake: Lake, table: str, silver_rows: DataFrame) -> DataFrame:
    """The fact columns, those the silver table has gained, and those the facts had before."""
    source, columns = FACT_SOURCES[table]
    facts = silver_rows.select(*columns, *[f.name for f in lake.gained(spark, "silver", source)])
    return conform(facts, lake.evolve(spark, "gold", table, facts.schema))


def start_gold(spark: SparkSession, lake: Lake, tables=GOLD_TABLES, dims: str = "merge",
               trigger: str = "available_now", max_files_per_trigger: int | None = None,
               state_partitions: int | None = None, date_partitioned: bool = False) -> list[StreamingQuery]:
    """silver -> facts (append) and dimensions (``merge``, ``state`` or ``salted`` mode, see
    :mod:`velolake.streaming.dims`).  Columns that a
    silver table has gained go on to its facts (S8).  ``date_partitioned`` stores the facts by ``event_date`` (see :func:`gold.with_event_date`)."""
    def facts_sink(df: DataFrame, path: str, ckpt: str):
        if date_partitioned:
            # A day's rows go to DAY_FILES tasks, so a batch writes at most that many files a
            # day however many tasks read it, and a hot day is still shared.
            dated = gold.with_event_date(df)
            salt = F.pmod(F.xxhash64(*df.columns), F.lit(DAY_FILES))
            return append_sink(dated.repartition("event_date", salt), path, ckpt, trigger, partition_by=["event_date"])
        return append_sink(df, path, ckpt, trigger)

    def rides() -> DataFrame:
        return gold.with_event_ts(lake.read_stream(spark, "silver", TOPICS["rides"], max_files_per_trigger))

    def telemetry() -> DataFrame:
        return gold.with_event_ts(lake.read_stream(spark, "silver", TOPICS["telemetry"], max_files_per_trigger))

    if dims not in ("merge", "state", "salted"):
        raise ValueError(f"unknown kind of dimensions {dims!r}")
    out = []
    for t in tables:
        # the kinds of dimension keep different state, so each has a checkpoint of its own
        own = f"{t}_{dims}" if t.startswith("dim_") and dims != "merge" else t
        path, ckpt = lake.table("gold", t), lake.checkpoint("gold", own)
        if t == "fact_rides":
            out.append(facts_sink(evolved_facts(spark, lake, t, rides()), path, ckpt))
        elif t == "fact_telemetry":
            out.append(facts_sink(evolved_facts(spark, lake, t, telemetry()), path, ckpt))
        elif t in ("dim_payment_method", "dim_city"):
            key = t[len("dim_"):]
            if dims == "merge":
                out.append(batch_sink(rides().select(key), D.merge_writer(path, [key]), ckpt, trigger))
            else:
                dedup = D.dedup_salted if dims == "salted" else D.dedup_state
                out.append(append_sink(dedup(rides(), key), path, ckpt, trigger, state_partitions=state_partitions))
        elif t == "dim_time_hourly":
            if dims == "merge":
                hours = D.hours_of(rides()).unionByName(D.hours_of(telemetry()))
                out.append(batch_sink(hours, D.merge_writer(path, ["hour_start"], finish=gold.with_calendar),
                                      ckpt, trigger))
            else:
                times = rides().select("event_ts").unionByName(telemetry().select("event_ts"))
                hours = D.hours_salted(times) if dims == "salted" else D.hours_state(times)
                out.append(append_sink(hours, path, ckpt, trigger, state_partitions=state_partitions))
        else:
            raise ValueError(f"unknown gold table {t!r}")
    return out


def start_gold_topics(spark: SparkSession, lake: Lake, trigger: str = "available_now",
                      max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """silver -> all five gold tables by two queries, one a topic, each of which reads its silver
    rows once (W8): :func:`start_gold` reads the rides four times and telemetry twice.

    Facts lie in a folder a batch, dimensions as in ``merge`` mode.  Both topics bring hours, so
    ``dim_time_hourly`` has a part for each and :func:`read_gold` returns an hour once.  A lake
    has its gold from one of the two forms: their checkpoints are different ones."""
    out = []
    for kind, table in (("rides", "fact_rides"), ("telemetry", "fact_telemetry")):
        silver_rows = lake.read_stream(spark, "silver", TOPICS[kind], max_files_per_trigger)
        columns = evolved_facts(spark, lake, table, gold.with_event_ts(silver_rows)).schema
        dimensions = [(f"{lake.table('gold', 'dim_time_hourly')}/{D.TOPIC_COL}={kind}", "hour_start", gold.with_calendar)]
        if kind == "rides":
            dimensions += [(lake.table("gold", f"dim_{k}"), k, None) for k in ("payment_method", "city")]

        def facts(df: DataFrame, columns=columns) -> DataFrame:
            return conform(gold.with_event_ts(df), columns).select(*columns.fieldNames())

        out.append(batch_sink(silver_rows, D.topic_writer(lake.table("gold", table), facts, dimensions),
                              lake.checkpoint("gold", f"topic_{kind}"), trigger, name=f"gold_{kind}"))
    return out


def start_marts(spark: SparkSession, lake: Lake, window: str = K.MART_WINDOW_DURATION,
                watermark: str = K.MART_WATERMARK, exact: bool = False, trigger: str = "available_now",
                max_files_per_trigger: int | None = None,
                state_partitions: int | None = None, date_partitioned: bool = False,
                by_batch: bool = False) -> list[StreamingQuery]:
    """gold facts -> windowed marts under a watermark (append: a window is written once,
    when the watermark passes its end; rows for an already-closed window are dropped)."""
    folders = StructType([*(schemas.DATE if date_partitioned else []), *(schemas.BATCH if by_batch else [])])
    fr = lake.read_stream(spark, "gold", "fact_rides", max_files_per_trigger, schema=folders)
    ft = lake.read_stream(spark, "gold", "fact_telemetry", max_files_per_trigger, schema=folders)
    jobs = [
        ("mart_revenue_hourly", marts.revenue_mart(fr, window=window, exact=exact, watermark=watermark)),
        ("mart_fleet_health_hourly", marts.fleet_mart(ft, window=window, exact=exact, watermark=watermark)),
    ]
    return [append_sink(df, lake.table("mart", t), lake.checkpoint("mart", t), trigger,
                        state_partitions=state_partitions) for t, df in jobs]


def start_sketch_marts(spark: SparkSession, lake: Lake, window: str = K.MART_WINDOW_DURATION,
                       watermark: str = K.MART_WATERMARK, trigger: str = "available_now",
                       max_files_per_trigger: int | None = None,
                       state_partitions: int | None = None) -> list[StreamingQuery]:
    """gold facts -> marts of sketches, which roll up to wider windows and to totals (see
    :mod:`velolake.operators.sketches`); state is one row of a fixed size a window."""
    jobs = [("fact_rides", "mart_revenue_sketch", sketches.revenue_sketch_mart),
            ("fact_telemetry", "mart_fleet_sketch", sketches.fleet_sketch_mart)]
    return [append_sink(mart(lake.read_stream(spark, "gold", fact, max_files_per_trigger), window, watermark),
                        lake.table("mart", t), lake.checkpoint("mart", t), trigger, state_partitions=state_partitions)
            for fact, t, mart in jobs]


def read_gold(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    known = schemas.TABLE_SCHEMAS.get(f"gold/{table}")
    if table.startswith("dim_"):
        return D.read_dimension(spark, lake.table("gold", table), known)
    return lake.read(spark, "gold", table).drop(D.BATCH_COL)


def run_incremental(spark: SparkSession, lake: Lake, layers=("bronze", "silver", "gold", "mart"),
                    window: str = K.MART_WINDOW_DURATION, watermark: str = K.MART_WATERMARK,
                    exact: bool = False, dims: str = "merge", undecided: str = "drop",
                    max_files_per_trigger: int | None = None, state_partitions: int | None = None,
                    date_partitioned: bool = False, payloads: dict[str, StructType] | None = None,
                    one_read: bool = False) -> None:
    """Run the given layers in order, each as an ``availableNow`` increment (the manual
    run sheet: Silver, then Gold, then Mart).  Safe to repeat: each query resumes from
    its checkpoint and only new input is processed.  ``one_read`` takes :func:`start_gold_topics`
    for gold.  ``state_partitions``: see :func:`velolake.streaming.sinks.append_sink`."""
    m = max_files_per_trigger
    for layer in layers:
        if layer == "bronze":
            run_layer(start_bronze(spark, lake, max_files_per_trigger=m))
        elif layer == "silver":
            run_layer(start_silver(spark, lake, undecided=undecided, max_files_per_trigger=m, payloads=payloads))
        elif layer == "gold" and one_read:
            run_layer(start_gold_topics(spark, lake, max_files_per_trigger=m))
        elif layer == "gold":
            run_layer(start_gold(spark, lake, dims=dims, max_files_per_trigger=m,
                                 state_partitions=state_partitions, date_partitioned=date_partitioned))
        elif layer == "mart":
            run_layer(start_marts(spark, lake, window=window, watermark=watermark, exact=exact,
                                  max_files_per_trigger=m, state_partitions=state_partitions,
                                  date_partitioned=date_partitioned, by_batch=one_read))
        else:
            raise ValueError(f"unknown layer {layer!r}")
