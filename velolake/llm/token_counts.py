"""Token counts: a vectorised separator scan over flat token files without an index.

Blocks of the files are searched on their own; a prefix scan over one row a block then
joins the documents that lie across block borders.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velolake.llm.bpe import TOKENIZER, Codec
from velolake.llm.common import materialize, read_table, slices, work_path

SEPARATOR = "<|endoftext|>"
HEADER = 5               # tokens before a document's own that spell its id
BLOCK_TOKENS = 1 << 19
SUPER = 4096             # blocks that the first level of the prefix scan goes over
FILE_BYTES = 1 << 24     # of one file, as a file is read by one task; a longer document is a file of its own
NO_ID = 1 << 64          # spelled for a null doc_id


@lru_cache(maxsize=2)
def plain_codec(path: str) -> Codec:
    """Special-token strings in a text are ordinary text here: no document holds a separator."""
    codec = Codec(path)
    codec.tok.encode_special_tokens = True
    codec.special = {}
    return codec


def token_type(path: str) -> tuple[str, int]:
    """The numpy type of a file's tokens, and the separator's id."""
    codec = Codec(path)
    return "<u2" if max(codec.bytes_of) < 1 << 16 else "<u4", codec.special[SEPARATOR]


def spell(doc_id: int | None, base: int) -> list[int]:
    """The id in ``HEADER`` digits below ``base``, so that none is the separator."""
    value = NO_ID if doc_id is None else doc_id + (1 << 63)
    return [value // base ** k % base for k in range(HEADER)]


def unspell(digits: np.ndarray, base: int) -> list[int | None]:
    out = []
    for row in digits.tolist():
        value = sum(d * base ** k for k, d in enumerate(row))
        out.append(None if value == NO_ID else value - (1 << 63))
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Flat files of little-endian ids: each document's header and tokens, then a separator.

    Spark's text writer puts the bytes out as they are, with the separator's bytes as the
    end of a line, to whatever store ``path`` is on.  Nothing is shuffled.  A line holds
    documents up to ``FILE_BYTES`` in all, or one longer document, and is a file of its own.
    """
    kind, end = token_type(tokenizer)
    end_bytes = np.array([end], kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = plain_codec(tokenizer)
        held: list[bytes] = []
        size = 0

        def line() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([end_bytes.join(held)], pa.binary())], names=["value"])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.frombuffer(codec.encode(text.as_py()), "<u4").astype(kind)
                one = np.array(spell(doc_id.as_py(), end), kind).tobytes() + ids.tobytes()
                if held and size + len(one) > FILE_BYTES:
                    yield line()
                    held, size = [], 0
                held.append(one)
                size += len(one) + len(end_bytes)
        if held:
            yield line()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "value binary")
    (rows.select(F.col("value").cast("string")).write.option("lineSep", end_bytes.decode("latin-1"))
     .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path))


def scan_blocks(spark: SparkSession, path: str, kind: str, end: int, header: int, block_tokens: int) -> DataFrame:
    """One row for each document found whole in a block (``doc_id``, ``start``, ``stop``), and
    for each block one with its first separator ``stop`` and the document ``doc_id``,
    ``start`` left open at its end; positions are tokens in the file.

    A block carries the ``header`` tokens that follow it, so that each document's header is
    read by the block that holds the separator before it.
    """
    size = np.dtype(kind).itemsize
    base = end
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    total = (F.col("length") / size).cast("long")
    last = F.floor((total - 1) / block_tokens)
    blocks = files.where("length > 0").select(
        F.col("path").alias("file"), "content", total.alias("total"),
        F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")).select(
        "file", "block", "total", F.substring(
            "content", (F.col("block") * (block_tokens * size) + 1).cast("int"), F.lit((block_tokens + header) * size)).alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, total, data in zip(*(batch.column(c) for c in ("file", "block", "total", "data"))):
                file, block, total = file.as_py(), block.as_py(), total.as_py()
                tokens = np.frombuffer(data.as_py(), kind)
                first = block * block_tokens
                own = tokens[:min(block_tokens, total - first)]
                ends = np.flatnonzero(own == end)
                starts = ends + 1
                if block == 0:
                    starts = np.concatenate(([0], starts))
                starts = starts[first + starts < total]
                if first + len(own) == total and own[-1] != end:
                    ends = np.append(ends, len(own))  # the file's last document has no separator
                if header:
                    spelled = np.zeros((len(starts), header), np.int64)
                    at = starts[:, None] + np.arange(header)
                    spelled[:] = tokens[np.minimum(at, len(tokens) - 1)]
                    ids = unspell(spelled, base)
                else:
                    ids = [None] * len(starts)
                closing = ends[1:] if block else ends  # later blocks' first end closes an older document
                whole = min(len(starts), len(closing))
                left = whole < len(starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([file] * (whole + 1)), pa.array([block] * (whole + 1), pa.int64()),
                    pa.array([False] * whole + [True]), pa.array(ids[:whole] + [ids[whole] if left else None], pa.int64()),
                    pa.array([int(first + x) for x in starts[:whole]] + [int(first + starts[whole]) if left else None], pa.int64()),
                    pa.array([int(first + x) for x in closing[:whole]] + [int(first + ends[0]) if block and len(ends) else None], pa.int64())],
                    names=["file", "block", "edge", "doc_id", "start", "stop"])

    return blocks.mapInArrow(run, "file string, block long, edge boolean, doc_id long, start long, stop long")


def token_counts(spark: SparkSession, path: str, kind: str, end: int, header: int = 0,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, start, n_tokens, doc_id) of every document in the flat files at ``path``.

    ``n_tokens`` leaves out the header and the separator; without a header ``doc_id`` is null.
    Two separators with nothing between them are an empty document.  What lies across blocks
    is stitched by a prefix scan in two levels, over ``SUPER`` blocks and over their results,
    so that no task gets more than a few thousand rows for each file of any length.
    """
    found = materialize(scan_blocks(spark, path, kind, end, header, block_tokens), "token-blocks")
    edges = found.where("edge").withColumn("super", F.floor(F.col("block") / SUPER)).withColumn(
        "open", F.when(F.col("start").isNotNull(), F.struct("doc_id", "start")))
    before = (Window.unboundedPreceding, -1)
    near = F.last("open", ignorenulls=True).over(Window.partitionBy("file", "super").orderBy("block").rowsBetween(*before))
    tops = edges.where("open is not null").groupBy("file", "super").agg(F.max_by("open", "block").alias("open"))
    every = edges.select("file", "super").distinct().join(tops, ["file", "super"], "left")
    far = every.select("file", "super", F.last("open", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("super").rowsBetween(*before)).alias("far"))
    across = (edges.withColumn("near", near).where("stop is not null").join(far, ["file", "super"])
              .select("file", F.coalesce("near", "far").alias("open"), "stop")
              .select("file", "open.start", "stop", "open.doc_id"))
    whole = found.where("not edge").select("file", "start", "stop", "doc_id").union(across)
    return whole.select("file", "start", (F.col("stop") - F.col("start") - header).alias("n_tokens"), "doc_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files written from the whole table.

    Nulls and odd input: a null or empty text has no tokens; null ids and repeated rows are
    documents of their own; other columns are not read; an empty table gives an empty result.
    """
    path = work_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path)
    kind, end = token_type(TOKENIZER)
    return token_counts(spark, path, kind, end, HEADER).select("doc_id", "n_tokens")
