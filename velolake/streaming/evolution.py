"""Schema evolution of append tables.

The columns of a lake table are kept beside it, one row a version, and are merged at each start
of its writer from the stored ones and the plan's: what the plan adds is appended as a nullable
column, what it no longer has stays and is written as NULL.  Readers, streaming ones with old
checkpoints included, take the stored columns; files from before a column was added read NULL
there.  A column never changes its type: that is an error before anything is written.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from velolake.sources.tables import is_missing

_VERSIONS = "version long, columns string"


class SchemaConflict(ValueError):
    """A plan writes a column of a table with another type than the table has."""


def merged(stored: StructType, planned: StructType) -> StructType:
    """``stored`` and behind it the columns that only ``planned`` has, all nullable."""
    kinds = {f.name: f.dataType for f in stored}
    clash = [f"{f.name}: {kinds[f.name].simpleString()} is stored, {f.dataType.simpleString()} is written"
             for f in planned if f.name in kinds and kinds[f.name] != f.dataType]
    if clash:
        raise SchemaConflict("; ".join(clash))
    return StructType([StructField(f.name, f.dataType, True) for f in [*stored, *(f for f in planned if f.name not in kinds)]])


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The newest version kept at ``path``; None if there is none."""
    try:
        rows = spark.read.schema(_VERSIONS).json(path)
        last = rows.agg(F.max_by("columns", "version")).first()[0]  # one row a version
    except AnalysisException as exc:
        if not is_missing(exc):
            raise
        return None
    return None if last is None else StructType.fromJson(json.loads(last))


def evolve(spark: SparkSession, path: str, base: StructType, planned: StructType) -> StructType:
    """The table's columns from this start on; a new version is kept if they have changed.

    ``base`` are the columns of a table that has no version yet.  A table has one writer, so
    versions do not compete; a start that fails later leaves a version that the next start finds
    unchanged.
    """
    before = stored_schema(spark, path)
    after = merged(before or base, planned)
    if after != (before or merged(base, StructType([]))):
        version = 1 + spark.read.schema(_VERSIONS).json(path).count() if before else 1
        spark.createDataFrame([(version, after.json())], _VERSIONS).coalesce(1).write.mode("append").json(path)
    return after


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its order, NULL where ``df`` has none; other
    columns (a sink's partition columns) follow."""
    have = set(df.columns)
    return df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema],
                     *[c for c in df.columns if c not in set(schema.fieldNames())])
