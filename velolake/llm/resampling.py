"""Importance resampling: documents drawn by how much their features speak for a target corpus.

Feature buckets are counted over all documents and all target texts; the logarithms of their
rates' ratios are one array, by which every document is weighed where it is read.  Gumbel
noise turns the draw without replacement into the choice of the highest scores.  The last of
these is found exactly by weighted median of medians: chunks of keys send their medians and
sizes, the median of medians by size splits the keys, and the side without the cutoff, at least
a quarter of what remains, is discarded.  Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from velolake.llm.common import materialize, read_table, slices, term_blocks

BUCKETS = 10_000
LONGEST = 1            # words in a feature at most
LEAST_WORDS = 20       # shorter documents are not drawn
PERCENT = 10
SEED = 2024
CHUNK_KEYS = 1 << 20   # keys whose median is taken together
FINISH = 4096          # remaining keys that are read at once instead of halved further
CACHED = 1 << 20       # buckets of different words that a task remembers
LAST_ID = (1 << 63) - 1  # stands for a null doc_id, after all others


class Buckets(dict):
    """Bucket of a feature: its crc32 modulo ``size``, remembered."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[feature] = out = zlib.crc32(feature) % self.size
        return out


def feature_buckets(text: bytes, buckets: Buckets, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(new words, buckets of the features that end in them) for each block of the text."""
    before: list[bytes] = []
    for words in term_blocks(text):
        features = words
        if longest > 1:
            run, at = before + words, len(before)
            features = words + [b" ".join(run[end - n:end]) for n in range(2, longest + 1)
                                for end in range(max(n, at + 1), len(run) + 1)]
            before = run[-(longest - 1):]
        yield len(words), np.fromiter(map(buckets.__getitem__, features), np.int64, len(features))


def bucket_counts(texts: DataFrame, size: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all rows' ``text`` (binary) fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(size), np.zeros(size, np.int64)
        for batch in slices(batches):
            for text in batch.column("text"):
                for _, got in feature_buckets(text.as_py() or b"", buckets, longest):
                    total += np.bincount(got, minlength=size) if len(got) > size // 8 else 0
                    if len(got) <= size // 8:
                        np.add.at(total, got, 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(size, np.int64)
    # At most one row a bucket.
    for bucket, n in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain, a thousand times the logarithm of its rates' ratio, rounded down."""
    total, wanted, size = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (total + size) / ((s + 1) * (wanted + size))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """The input's rows in a struct ``row``, with ``n_features``, ``n_words`` and ``weight``, the
    mean gain of the features rounded down (0 without features)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        buckets = Buckets(len(gain))
        for batch in slices(batches):
            out = []
            for text in batch.column("text"):
                words = features = total = 0
                for new, got in feature_buckets(text.as_py() or b"", buckets, longest):
                    words, features, total = words + new, features + len(got), total + int(gain[got].sum())
                out.append((features, words, total // features if features else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(x, pa.int64()) for x in zip(*out))],
                names=["row", "n_features", "n_words", "weight"])

    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*rest).alias("row"), F.col("text").cast("binary").alias("text"))
    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, n_features long, n_words long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousandfold Gumbel variate of the id, rounded down; a null id counts as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def cutoff(keys: DataFrame, wanted: int, chunk: int = CHUNK_KEYS, finish: int = FINISH) -> tuple | None:
    """The ``wanted``-th smallest of the keys (columns a, b, c, all long, compared in this order).

    Each round is one job over the keys that remain: every chunk splits its keys at the pivot
    and sends the size and the median of either side.  The next pivot is the median of the
    medians, weighted by size, of the side that holds the cutoff; it has at least a quarter of
    that side's keys on either side of it, whatever the chunks.  What reaches the driver is two
    rows a chunk, and at the end ``finish`` keys.
    """
    if wanted < 1:
        return None
    names = ["a", "b", "c"]

    def inside(low: tuple | None, high: tuple | None) -> DataFrame:
        rows = keys.select(*names)
        above = lambda k: (F.col("a") > k[0]) | ((F.col("a") == k[0]) & (
            (F.col("b") > k[1]) | ((F.col("b") == k[1]) & (F.col("c") > k[2]))))
        if low is not None:  # the first condition reaches the scan
            rows = rows.where(F.col("a") >= low[0]).where(above(low))
        if high is not None:
            rows = rows.where(F.col("a") <= high[0]).where(~above(high))
        return rows

    def sides(pivot: tuple | None):
        def send(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            key = [np.concatenate([b.column(k).to_numpy() for b in held]) for k in names]
            order = np.lexsort(key[::-1])
            key = [k[order] for k in key]
            n = len(order)
            if pivot is None:
                split = n
            else:
                below = key[2] <= pivot[2]
                for k, p in ((key[1], pivot[1]), (key[0], pivot[0])):
                    below = (k < p) | ((k == p) & below)
                split = int(below.sum())
            rows = [(side, hi - lo, *(int(k[(lo + hi - 1) // 2]) for k in key))
                    for side, lo, hi in ((0, 0, split), (1, split, n)) if hi > lo]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["side", "n", *names])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                held.append(batch)
                n += batch.num_rows
                if n >= chunk:
                    yield send(held)
                    held, n = [], 0
            if held:
                yield send(held)
        return run

    low = high = pivot = None
    while True:
        rows = inside(low, high).mapInArrow(sides(pivot), "side long, n long, a long, b long, c long").collect()
        below = sum(r["n"] for r in rows if r["side"] == 0)
        if pivot is None:
            if not below:
                return None
            wanted = min(wanted, below)
        elif wanted == below:
            return pivot
        side = 0 if wanted <= below else 1
        if pivot is not None:
            low, high = (low, pivot) if side == 0 else (pivot, high)
            wanted -= below if side else 0
        medians = sorted((tuple(r[k] for k in names), r["n"]) for r in rows if r["side"] == side)
        left = sum(n for _, n in medians)
        if left <= finish:
            return sorted(tuple(r) for r in inside(low, high).collect())[wanted - 1]
        run = 0
        for pivot, n in medians:
            run += n
            if 2 * run >= left:
                break


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` by the columns a, b, c: parts of a range partitioning are
    numbered each by itself, after the rows of the parts before."""
    order = ["a", "b", "c"]
    parts = materialize(winners.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "resample-winners")
    before, offsets = 0, []
    for part, n in parts.groupBy("part").count().orderBy("part").collect():  # one row a partition
        offsets.append((part, before))
        before += n
    spark = winners.sparkSession
    starts = spark.createDataFrame(offsets, "part int, before long")
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long")
    return parts.withColumn("rank", number).join(F.broadcast(starts), "part").withColumn(
        "rank", F.col("rank") + F.col("before")).drop("part", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, buckets: int = BUCKETS,
             longest: int = LONGEST, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text).

    ``rank`` counts the drawn documents from the highest score on, and is null for the others.

    Nulls and odd input: a null or empty text has no feature, weight 0, and is not drawn; a null
    doc_id counts as the empty text for the noise and comes last among equal scores; rows that
    share doc_id and score rank in the order of the table; every row counts, repeated ones too;
    an empty table gives an empty result, an empty target rates from the added ones alone; a
    text of any length is read whole in blocks; other columns are not read.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    gain = gains(bucket_counts(rows, buckets, longest),
                 bucket_counts(target.select(F.col("text").cast("binary").alias("text")), buckets, longest))
    score = F.col("weight") + noise(F.col("row.doc_id"), seed)
    scored = materialize(weigh(rows, gain, longest).select(
        "row.doc_id", "n_features", "n_words", "weight", score.cast("long").alias("score"),
        (-score).cast("long").alias("a"), F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST_ID)).alias("b"),
        F.monotonically_increasing_id().alias("c")).sortWithinPartitions("a"), "resample-scored")
    able = F.col("n_words") >= least_words
    first = cutoff(scored.where(able), percent * scored.where(able).count() // 100)
    names = ["doc_id", "n_features", "weight", "score"]
    if first is None:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    a, b, c = (F.lit(k).cast("long") for k in first)
    drawn = able & ((F.col("a") < a) | ((F.col("a") == a) & ((F.col("b") < b) | ((F.col("b") == b) & (F.col("c") <= c)))))
    return ranked(scored.where(drawn)).select(*names, "rank").unionByName(
        scored.where(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# crc32 by its table of 256 entries, which the first two expressions make from the polynomial.
OP13_SQL = f"""
WITH steps AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
               FROM range(256) AS r(i)),
tab AS (SELECT list(v ORDER BY i) AS t FROM steps),
texts AS (SELECT doc_id, 0 AS side, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark),
words AS (SELECT doc_id, side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
tokens AS (SELECT doc_id, side, unnest(w) AS f FROM words),
spelt AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM tokens)),
crc AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                      lambda acc, b: xor(acc >> 8, t[1 + (xor(acc, b) & 255)])), 4294967295) % {BUCKETS} AS bucket FROM spelt, tab),
hits AS (SELECT doc_id, side, bucket FROM tokens JOIN crc USING (f)),
per AS (SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM hits GROUP BY bucket),
tot AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM per),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::BIGINT AS g FROM per, tot),
weights AS (SELECT doc_id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM hits JOIN gain USING (bucket) WHERE side = 0 GROUP BY doc_id),
noise AS (SELECT doc_id, ('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT AS h FROM documents),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
           FROM noise LEFT JOIN weights USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * able // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
