"""JSON payload parsing (bronze text -> typed silver columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_payload(bronze: DataFrame, schema: StructType,
                  text_col: str = "raw_json", time_col: str = "kafka_timestamp") -> DataFrame:
    """``raw_json`` -> one typed column per payload field, plus ``bronze_ingestion_time``.

    Permissive: unknown keys are ignored, missing keys and values of the wrong type
    become NULL for that field only, and text that is not JSON gives an all-NULL row
    (which the rule sets then quarantine).

    The parsed struct is flattened with a one-element ``inline`` rather than
    ``data.*``.  Same rows and columns, but the generator is a boundary the optimizer
    does not push predicates through: the rule-set verdict filters the parsed
    columns, instead of being rewritten into a filter that re-parses the text once per
    field reference, below any repartition and outside whole-stage codegen
    (measured 4x slower on silver).  Each message is parsed exactly once.
    """
    return bronze.select(
        F.col(time_col).alias("bronze_ingestion_time"),
        F.inline(F.array(F.from_json(F.col(text_col), schema))),
    )
