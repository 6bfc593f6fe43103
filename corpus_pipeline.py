"""Corpus pipeline: language ID, line dedup, SimHash near-dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; its
result is written to the shared folder and reread as the next one's ``docs``, so a lost
executor costs at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm.bpe import token_digests
from velolake.llm.common import let_workers_import, materialize, read_table
from velolake.llm.decontamination import keep_clean
from velolake.llm.language_id import keep_known
from velolake.llm.line_dedup import dedup_lines
from velolake.llm.simhash import keep_first

# SQL has no language model, SimHash, edit matching or BPE; tests/llm/test_pipeline.py holds
# run() against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that no learned language covers, such as those without a letter."""
    let_workers_import(spark)
    return keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many documents share; ``n_chars`` follows the kept text."""
    kept = dedup_lines(docs).select("row.*")
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that of the smallest doc_id."""
    let_workers_import(spark)
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of ``benchmark``."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of the documents that are left."""
    let_workers_import(spark)
    return token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("encode_bpe", encode_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
