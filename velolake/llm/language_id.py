"""Language ID: n-grams looked up in a bit-sliced Bloom filter that answers with language masks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from velolake.llm.common import crc_mod, materialize, read_table, slices

UNKNOWN = "und"
RATE = 2e-5       # an n-gram enters a language's filter from this share of its n-grams on
CONTRAST = 0.3    # ... and from this share of the highest rate of any language
HASHES = 3
ROWS_PER_GRAM = 16
CHUNK = 1 << 21   # characters worked on at once
MIN_SCORE = 0.15  # the pipeline stage rejects documents below

_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Lower-case code point of every letter, 32 (the separator) for everything else."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def text_blocks(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[str, list[int], list[int]]]:
    """Texts joined into strings of about ``size``: (joined, positions in ``texts``, starts).

    A longer text comes in pieces that overlap by two characters, so that no trigram is lost
    or counted twice.
    """
    parts: list[str] = []
    who: list[int] = []
    starts: list[int] = []
    total = 0
    for k, text in enumerate(texts):
        text = text or ""
        for at in range(0, max(1, len(text)), size):
            end = at + size
            # pieces after the first begin two characters early, the last trigram is whole
            piece = (" " if at == 0 else "") + text[max(0, at - 2) if at else 0:end] + (" " if end >= len(text) else "")
            if total and total + len(piece) > size:
                yield "".join(parts), who, starts
                parts, who, starts, total = [], [], [], 0
            parts.append(piece)
            who.append(k)
            starts.append(total)
            total += len(piece)
    if parts:
        yield "".join(parts), who, starts


def trigrams(joined: str, starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams with a letter in the middle, and the piece each belongs to."""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = _fold_table()[points].astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    at = np.flatnonzero(c[1:-1] != 32)
    piece = np.searchsorted(starts, at, side="right") - 1
    # a trigram that reaches into the next piece belongs to none; pieces are padded or overlap
    ends = np.append(np.asarray(starts[1:], np.int64), len(c))
    whole = at + 2 < ends[piece]
    return code[at[whole]], piece[whole]


@dataclass
class LanguageModel:
    """Filter rows (one mask of ``words`` 64-bit words each), per-language fill and names."""

    names: list[str]
    rows: np.ndarray  # (m, words) uint64, bit l: a trigram of language l hashes here

    @property
    def shift(self) -> np.uint64:
        return np.uint64(64 - (len(self.rows).bit_length() - 1))

    def places(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        for mult in _MULT[:HASHES]:
            x = (codes ^ (codes >> np.uint64(29))) * mult
            yield ((x ^ (x >> np.uint64(32))) * _MULT[0]) >> self.shift

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """The languages of each n-gram: the AND of its filter rows, all languages at once."""
        out = None
        for at in self.places(codes):
            out = self.rows[at] if out is None else out & self.rows[at]
        return out

    def false_rate(self) -> np.ndarray:
        """Chance of an absent n-gram to be found, per language: its fill to the power of hashes."""
        bits = [((self.rows[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(self.names))]
        return np.array(bits) ** HASHES

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams per text, and hits per text and language corrected for false positives."""
        n = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(texts), len(self.names)))
        for joined, who, starts in text_blocks(texts):
            codes, piece = trigrams(joined, starts)
            np.add.at(n, who, np.bincount(piece, minlength=len(who)))
            if not len(codes) or not self.names:
                continue
            masks = self.masks(codes)
            first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            owner = np.asarray(who)[piece[first]]
            for k in range(len(self.names)):
                bit = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                np.add.at(hits[:, k], owner, np.add.reduceat(bit, first))
        false = self.false_rate() if self.names else np.zeros(0)
        rate = hits / np.maximum(n, 1)[:, None]
        return n, np.clip((rate - false) / (1 - false), 0, 1)


def build_filter(names: list[str], codes: np.ndarray, langs: np.ndarray) -> LanguageModel:
    """Set bit ``langs[i]`` in the filter rows of n-gram ``codes[i]``."""
    most = max([1, *np.bincount(langs, minlength=1)]) if len(langs) else 1
    size = 1 << max(10, int(most * ROWS_PER_GRAM - 1).bit_length())
    model = LanguageModel(names, np.zeros((size, max(1, -(-len(names) // 64))), np.uint64))
    for at in model.places(codes):
        np.bitwise_or.at(model.rows, (at, langs // 64), np.uint64(1) << (langs % 64).astype(np.uint64))
    return model


def train(labelled: DataFrame, rate: float = RATE, contrast: float = CONTRAST) -> LanguageModel:
    """Filter of ``labelled`` (text, lang): counts over all its rows, in Spark.

    An n-gram enters for a language if it makes at least ``rate`` of the language's n-grams
    and ``contrast`` of its highest rate in any language.  A language so has at most
    1 / ``rate`` entries, whatever the corpus: that bounds what comes to the driver and the
    filter that goes to every task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                for joined, _, starts in text_blocks([t for t, x in zip(texts, langs) if x == lang]):
                    codes, count = np.unique(trigrams(joined, starts)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)),
                         pa.array(count.astype(np.int64))], names=["lang", "code", "n"])

    counts = materialize(
        labelled.select("text", "lang").where("lang is not null and text is not null")
        .mapInArrow(run, "lang string, code bigint, n bigint")
        .groupBy("lang", "code").agg(F.sum("n").alias("n")), "language-counts")
    per_code = counts.groupBy("code").agg(F.collect_list(F.struct("lang", "n")).alias("in"))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    names = sorted(totals)
    if not names:
        return build_filter([], np.zeros(0, np.uint64), np.zeros(0, np.int64))
    total = F.create_map(*[F.lit(v) for k in names for v in (k, float(totals[k]))])
    rates = per_code.select("code", F.transform(
        "in", lambda x: F.struct(x["lang"].alias("lang"), (x["n"] / total[x["lang"]]).alias("r"))).alias("in"))
    best = F.array_max(F.transform("in", lambda x: x["r"]))
    rows = rates.select("code", best.alias("best"), F.explode("in").alias("x")).where(
        (F.col("x.r") >= rate) & (F.col("x.r") >= contrast * F.col("best"))).select("code", "x.lang").toPandas()
    index = {k: i for i, k in enumerate(names)}
    langs = np.array([index[x] for x in rows["lang"]], np.int64)
    return build_filter(names, rows["code"].to_numpy(np.int64).view(np.uint64), langs)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The input's rows in a struct ``row``, with ``lang_pred`` and ``score``.

    The language with most corrected hits wins, the first by name among equals; ``score`` is
    its share of the text's n-grams.  A text that is null or has no letter is ``und`` with
    score 0, as is every text if no language was learned.  Nothing but the text is looked
    at.  Repeated rows, very long texts and other columns need no care: each row is judged
    alone, a long text piece by piece.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, score = shared.value.scores(batch.column("row").field("text").to_pylist())
            names = shared.value.names
            if names:
                best = score.argmax(axis=1)
                lang = [names[b] if k else UNKNOWN for b, k in zip(best, n)]
                top = np.where(n > 0, score[np.arange(len(best)), best], 0.0)
            else:
                lang, top = [UNKNOWN] * len(n), np.zeros(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(top, pa.float64())],
                names=["row", "lang_pred", "score"])

    packed = docs.select(F.struct("*").alias("row"))
    schema = StructType([packed.schema["row"], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return packed.mapInArrow(run, schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = train(docs.where(~held))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), model).select(
        "row.doc_id", "row.held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that some learned language covers to at least ``min_score``."""
    model = train(docs)
    return predict(docs, model).where(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
