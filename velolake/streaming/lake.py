"""On-disk lake layout (S6): ``<root>/<layer>/<table>`` with per-layer checkpoint roots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from velolake import schemas
from velolake.session import new_lake_root
from velolake.sources.tables import read_table
from velolake.streaming.evolution import evolve, merged, stored_schema

# A topic's silver table is stored once, with a folder for each route.
ROUTES = {"silver": "valid", "silver_bad_data": "invalid"}
TOPICS = {"rides": "ride_events", "telemetry": "telemetry"}


@dataclass(frozen=True)
class Lake:
    root: str

    @classmethod
    def fresh(cls, spark: SparkSession, label: str = "lake") -> "Lake":
        """A new lake under the session's shared folder (``spark.checkpoint.dir``)."""
        return cls(new_lake_root(spark, label))

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/checkpoints/{name}"

    def schema_path(self, layer: str, name: str) -> str:
        """Where the versions of a table's columns are kept; both routes of silver are one table."""
        return f"{self.root}/{'silver' if layer in ROUTES else layer}/schemas/{name}"

    def schema(self, spark: SparkSession, layer: str, name: str) -> StructType:
        """The table's columns: the pinned ones, and behind them those it has gained since."""
        known = schemas.TABLE_SCHEMAS[f"{layer}/{name}"]
        kept = stored_schema(spark, self.schema_path(layer, name))
        if kept is None:
            return known
        return merged(known, StructType([f for f in kept if layer != "silver" or f.name != "error_message"]))

    def evolve(self, spark: SparkSession, layer: str, name: str, planned: StructType) -> StructType:
        """The columns that a writer whose plan gives ``planned`` has to write (see
        :mod:`velolake.streaming.evolution`)."""
        return evolve(spark, self.schema_path(layer, name), schemas.TABLE_SCHEMAS[f"{layer}/{name}"], planned)

    def gained(self, spark: SparkSession, layer: str, name: str) -> list[StructField]:
        """The columns a table has beyond the pinned ones."""
        known = set(schemas.TABLE_SCHEMAS[f"{layer}/{name}"].fieldNames())
        return [f for f in self.schema(spark, layer, name) if f.name not in known]

    def landing(self, topic: str) -> str:
        """Folder standing in for a message topic: envelope files (``value``, ``timestamp``)."""
        return f"{self.root}/landing/{topic}"

    def read(self, spark: SparkSession, layer: str, name: str, merge_schema: bool = False,
             strict: bool = False) -> DataFrame:
        """Batch snapshot; an absent table reads as empty with its known schema, or is an
        error if ``strict``.
        ``merge_schema`` unions the columns of files written before and after a payload
        gained fields (older rows read NULL there)."""
        known = schemas.TABLE_SCHEMAS.get(f"{layer}/{name}")
        if known is not None and not merge_schema:
            known = self.schema(spark, layer, name)
        schema = None if strict else known
        grown = known is not None and known != schemas.TABLE_SCHEMAS[f"{layer}/{name}"]
        if layer not in ROUTES:
            return read_table(spark, self.table(layer, name), schema, merge_schema, known if grown else None)
        stored = StructType([*known.fields, *(f for f in schemas.QUARANTINE_ERROR if layer == "silver"), schemas.ROUTE])
        df = read_table(spark, self.table("silver", name), schema, merge_schema, stored if grown else None)
        if "route" not in df.columns:  # a table that a batch job wrote for one route
            return df
        columns = [c for c in df.columns if c != "route" and (c != "error_message" or layer != "silver")]
        return df.where(F.col("route") == ROUTES[layer]).select(*(columns if merge_schema else known.fieldNames()))

    def read_stream(self, spark: SparkSession, layer: str, name: str,
                    max_files_per_trigger: int | None = None, schema=None) -> DataFrame:
        """Incremental read of a table's appends (S2).  A file stream needs its schema: the
        table's columns at this start (``schema`` adds to them, e.g. a partition column)."""
        known = merged(self.schema(spark, layer, name), schema or StructType([]))
        stored = StructType([*known.fields, schemas.ROUTE]) if layer in ROUTES else known
        reader = spark.readStream.schema(stored)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if layer not in ROUTES:
            return reader.parquet(self.table(layer, name))
        # the route is a folder, so the other route's files are not read; a batch-written table has none
        mine = F.coalesce("route", F.lit(ROUTES[layer])) == ROUTES[layer]
        return reader.parquet(self.table("silver", name)).where(mine).drop("route")
