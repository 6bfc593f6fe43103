"""The batch medallion pipeline over the driver's ``events`` table, as lazy frames.

Nothing here executes: each property is a logical plan, and every named query
composes them, so Catalyst sees events -> JSON -> parse -> rules -> facts -> marts
as one plan and prunes columns / pushes filters through all of it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from velolake import constants as K
from velolake.operators import gold, marts, silver
from velolake.session import apply_required_conf
from velolake.sources import sample
from velolake.sources.envelope import raw_envelope
from velolake.sources.tables import driver_table


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str, window: str = K.HOURLY):
        apply_required_conf(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.window = window

    @cached_property
    def events(self) -> DataFrame:
        return driver_table(self.spark, self.sf_dir, "events")

    # bronze
    @cached_property
    def bronze_rides(self) -> DataFrame:
        return raw_envelope(sample.messages(self.events, "rides"))

    @cached_property
    def bronze_telemetry(self) -> DataFrame:
        return raw_envelope(sample.messages(self.events, "telemetry"))

    # silver
    @cached_property
    def parsed_rides(self) -> DataFrame:
        return silver.parse_rides(self.bronze_rides)

    @cached_property
    def parsed_telemetry(self) -> DataFrame:
        return silver.parse_telemetry(self.bronze_telemetry)

    @cached_property
    def validated_rides(self) -> DataFrame:
        return silver.validate_rides(self.parsed_rides)

    @cached_property
    def validated_telemetry(self) -> DataFrame:
        return silver.validate_telemetry(self.parsed_telemetry)

    @cached_property
    def silver_rides(self) -> DataFrame:
        return silver.valid_rows(self.validated_rides)

    @cached_property
    def silver_telemetry(self) -> DataFrame:
        return silver.valid_rows(self.validated_telemetry)

    @cached_property
    def quarantine_rides(self) -> DataFrame:
        return silver.quarantine_rows(self.validated_rides)

    @cached_property
    def quarantine_telemetry(self) -> DataFrame:
        return silver.quarantine_rows(self.validated_telemetry)

    # gold
    @cached_property
    def fact_rides(self) -> DataFrame:
        return gold.fact_rides(self.silver_rides)

    @cached_property
    def fact_telemetry(self) -> DataFrame:
        return gold.fact_telemetry(self.silver_telemetry)

    # marts (exact counts; see velolake.operators.marts)
    @cached_property
    def mart_revenue(self) -> DataFrame:
        return marts.revenue_mart(self.fact_rides, window=self.window, exact=True)

    @cached_property
    def mart_fleet(self) -> DataFrame:
        return marts.fleet_mart(self.fact_telemetry, window=self.window, exact=True)


class StoredTables:
    """Gold facts and marts written once as Parquet tables in a fresh lake under the
    shared folder, then read back - the state the validation job sees in the reference
    pipeline.  Checks that scan several tables then read stored data instead of each
    re-running the pipeline from ``events``; the write also cuts the lineage."""

    def __init__(self, f: Frames, label: str = "stored", rides: bool = True, telemetry: bool = True):
        from velolake.streaming.lake import Lake
        spark = f.spark
        lake = self.lake = Lake.fresh(spark, label)
        if rides:
            f.fact_rides.write.parquet(lake.table("gold", "fact_rides"))
            self.fact_rides = lake.read(spark, "gold", "fact_rides")
            marts.revenue_mart(self.fact_rides, window=f.window, exact=True).write.parquet(
                lake.table("mart", "mart_revenue_hourly"))
            self.mart_revenue = lake.read(spark, "mart", "mart_revenue_hourly")
        if telemetry:
            f.fact_telemetry.write.parquet(lake.table("gold", "fact_telemetry"))
            self.fact_telemetry = lake.read(spark, "gold", "fact_telemetry")
            marts.fleet_mart(self.fact_telemetry, window=f.window, exact=True).write.parquet(
                lake.table("mart", "mart_fleet_health_hourly"))
            self.mart_fleet = lake.read(spark, "mart", "mart_fleet_health_hourly")


def with_faults(t: StoredTables) -> list[DataFrame]:
    """The four stored tables with faults that every check of the report must find."""
    minutes, signal = F.col("duration_mins"), F.col("signal_strength")
    early = F.hour("hour_start") == 5
    return [
        t.fact_rides.withColumns({
            "fare_amount": F.when(minutes % 7 == 0, -1 - F.col("fare_amount")).otherwise(F.col("fare_amount")),
            "distance_km": F.when(minutes % 11 == 0, -1 - F.col("distance_km")).otherwise(F.col("distance_km")),
            "user_id": F.when(minutes % 13 != 0, F.col("user_id"))}),
        t.fact_telemetry.withColumns({
            "battery_level": F.when(signal == 3, F.col("battery_level") + 150).otherwise(F.col("battery_level")),
            "scooter_status": F.when(signal != 4, F.col("scooter_status"))}),
        t.mart_revenue.withColumns({
            "completed_rides": F.col("completed_rides") * 2, "total_revenue": F.when(~early, F.col("total_revenue"))}),
        t.mart_fleet.withColumns({
            "fleet_size_seen": F.col("fleet_size_seen") + 100000,
            "avg_battery_level": F.when(~early, F.col("avg_battery_level"))}),
    ]


def as_ntz(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Return TIMESTAMP columns as wall-clock UTC ``TIMESTAMP_NTZ`` (the SQL ``TIMESTAMP``).

    ``digits`` rounds the doubles of a *result*, for queries that sum or average them: the
    last bits of such a sum depend on the order of the rows, in any engine."""
    def shown(f) -> Column:
        if isinstance(f.dataType, TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if digits is not None and isinstance(f.dataType, DoubleType):
            return F.round(f.name, digits).alias(f.name)
        return F.col(f.name)
    return df.select(*map(shown, df.schema.fields))
