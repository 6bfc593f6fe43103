"""Helpers shared by the text operators: table access, written intermediates, text expressions."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.session import shared_dir

# [\x20\x09-\x0D]: the white space of every contract of this package.
ASCII_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the import path of Python workers that are started from
    now on, as the driver may have found it by a path that they do not have."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared folder (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark)}/velolake-llm/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a reread and not the work above it, and a
    frame that several plans use is computed once.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ASCII-only strings take the byte-wise path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in smaller batches: what a task makes of them at once is bounded."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_blocks(data: bytes, block: int = 1 << 22) -> Iterator[list[bytes]]:
    """The white-space separated words of ``data`` in lists, one per ``block`` bytes.

    A cut is moved to the next space, so no word is split and a text of any length needs
    the memory of one block's word objects.
    """
    if len(data) <= block:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = min(len(data), at + block)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


# Every byte of a term by itself in lower case, and a space for what separates terms: terms are
# maximal runs of 0-9, A-Z, a-z and of characters from U+0080 on, which UTF-8 writes in high bytes.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def term_blocks(data: bytes, block: int = 1 << 22) -> Iterator[list[bytes]]:
    """The terms of UTF-8 ``data`` with A-Z lower-cased, in lists as ``word_blocks`` gives them."""
    yield from word_blocks(data.translate(_TERM_BYTES), block)
