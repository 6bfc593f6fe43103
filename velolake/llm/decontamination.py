"""Benchmark decontamination: pigeonhole pieces found exactly, verified by Myers' bit vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from velolake.llm.common import materialize, read_table, slices, work_path

ERROR_RATE = 0.05         # edits allowed per character of a test item
BLOCK_CHARS = 8_000_000   # item text whose automaton is held at once
REMEMBERED = 4096         # verified windows kept by a task


def normalise(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float) -> int:
    return math.floor(length * rate)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces (offset, text) of nearly equal length that make up the item.

    ``edits`` edits touch at most as many pieces, so one occurs unchanged in every match.
    """
    cut = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:]) if b > a]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        out[ch] = out.get(ch, 0) | 1 << i
    return out


def best_distance(pattern: str, peq: dict[str, int], window: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a substring of ``window``, and where it ends.

    Myers' algorithm: one column of the matrix in two bit vectors, a few operations on them
    per character of the window.
    """
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, ch in enumerate(window):
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = ph << 1 & full  # a match may begin anywhere: row 0 stays 0
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Items of one block: an automaton over their pieces, and their verification."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = items
        self.edits = [budget(len(t), rate) for _, t in items]
        self.peq: dict[int, dict[str, int]] = {}
        self.seen: dict[tuple[int, str], tuple[int, int]] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.edits[k]):
                where.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def verify(self, k: int, window: str) -> tuple[int, int]:
        key = (k, window)
        if key not in self.seen:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            peq = self.peq.setdefault(k, masks(self.items[k][1]))
            self.seen[key] = best_distance(self.items[k][1], peq, window)
        return self.seen[key]

    def matches(self, text: str) -> dict[int, tuple[int, int]]:
        """Item number to (least distance, end in ``text``) of the items within budget."""
        found: dict[int, tuple[int, int]] = {}
        if self.empty:
            return found
        tried: set[tuple[int, int]] = set()
        for end, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                start = end + 1 - size - offset
                if (k, start) in tried or found.get(k, (1, 0))[0] == 0:
                    continue
                tried.add((k, start))
                item, edits = self.items[k][1], self.edits[k]
                if start >= 0 and text.startswith(item, start):
                    found[k] = (0, start + len(item))
                    continue
                lo = max(0, start - edits)
                distance, at = self.verify(k, text[lo:start + len(item) + edits])
                if distance <= edits and distance < found.get(k, (edits + 1, 0))[0]:
                    found[k] = (distance, lo + at)
        return found


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of bounded text; a blank or null item matches nothing."""
    block: list[tuple[int, str]] = []
    size = 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        text = normalise(row["text"])
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The matches of every document, beside its row.

    Returns the input's rows in a struct ``row`` and ``found``, an array of (item_id,
    distance, end): for each test item with a substring of the document's normalised text
    within floor(rate * length) edits, the least distance among the places that share a
    piece with the item, and the character after the match.

    The test set is taken in blocks of bounded size, each broadcast and held against all
    documents in one pass over whole texts.  With one block nothing is shuffled; with several,
    what they found is, by row.

    Nulls and odd input: null or blank texts and items match nothing; a null doc_id or
    item_id is carried; repeated documents are judged each, items that repeat are reported
    each; an empty table of either kind gives no matches; other columns are carried.
    """
    match = StructType([StructField("item_id", benchmark.schema["item_id"].dataType),
                        StructField("distance", IntegerType()), StructField("end", LongType())])
    found = ArrayType(match)
    sc = docs.sparkSession.sparkContext
    blocks = item_blocks(benchmark, block_chars)
    first, second = next(blocks, None), next(blocks, None)
    packed = docs.select(F.struct("*").alias("row"))
    if first is None:
        return packed.withColumn("found", F.array().cast(found))
    if second is None:
        return packed.mapInArrow(_against(sc.broadcast(first), rate, "row", found, False),
                                 StructType([packed.schema["row"], StructField("found", found)]))
    # Several blocks: each is held against all documents by a job of its own, so one automaton is in
    # memory at once; what a block finds is written by row number, and the numbers are joined.
    rows = materialize(packed.withColumn("number", F.monotonically_increasing_id()), "leaks-rows")
    hits = StructType([StructField("number", LongType()), StructField("found", found)])
    paths = []
    for block in chain([first, second], blocks):
        shared = sc.broadcast(block)
        paths.append(work_path(docs.sparkSession, "leaks-found"))
        rows.select("number", F.struct("row.text").alias("row")).mapInArrow(
            _against(shared, rate, "number", found, True), hits).write.parquet(paths[-1])
        shared.unpersist()
    met = docs.sparkSession.read.schema(hits).parquet(*paths).groupBy("number").agg(
        F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    return rows.join(met, "number", "left").select("row", F.coalesce("found", F.array().cast(found)).alias("found"))


def _against(shared, rate: float, carried: str, found: ArrayType, hits_only: bool):
    """A task's work for one block of items: ``carried`` and the matches of each document."""
    kind = to_arrow_type(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for batch in slices(batches):
            out = []
            for text in batch.column("row").field("text").to_pylist():
                hits = matcher.matches(normalise(text))
                out.append([{"item_id": matcher.items[k][0], "distance": d, "end": e} for k, (d, e) in sorted(hits.items())])
            keep = pa.array([bool(x) or not hits_only for x in out], pa.bool_())
            made = pa.RecordBatch.from_arrays([batch.column(carried), pa.array(out, kind)], names=[carried, "found"])
            yield made.filter(keep)
    return run


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) match: doc_id, item_id and least distance."""
    found = leaks(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                  read_table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", F.explode("found").alias("m")).select(
        "doc_id", "m.item_id", "m.distance")


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents that hold no test item."""
    return leaks(docs, benchmark, rate).where(F.size("found") == 0).select("row.*")
