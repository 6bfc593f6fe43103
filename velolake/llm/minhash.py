"""Document fingerprints: one-permutation MinHash, optimal densification, packed low bits.

DataFrame functions only.  A fingerprint is made inside its row, by array functions, so no
shingle is ever shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velolake.llm.common import read_table

SHINGLE = 5
BIN_BITS = 8             # 256 bins, the top bits of a shingle's hash
BINS = 1 << BIN_BITS
LOW_BITS = 4             # bits kept of each bin's smallest hash
PROBES = 8               # places an empty bin looks at before it ranks all filled bins
ROWS_A_BUCKET = 2000     # documents that are put in order together
MOST_BUCKETS = 1 << 16

_REST = 64 - BIN_BITS
_LOW = (1 << _REST) - 1
_PER_LONG = 64 // LOW_BITS
_ONES = int("1".rjust(LOW_BITS, "0") * _PER_LONG, 2)


def once(column: Column) -> Column:
    """``column`` as a generator's output: computed once a row, and not again by each call of
    a lambda that uses it."""
    return F.explode_outer(F.array(column))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _longs(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" if v > -(1 << 63) else "-9223372036854775808L" for v in values) + ")")


def _mix(x: int) -> int:
    """A 64-bit finaliser; fixes the order in which an empty bin looks at others."""
    x = (x + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    return x ^ x >> 31


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the fingerprint of column ``text`` as an array of longs.

    Shingles are ``SHINGLE`` lower-cased words, split at ASCII white space, hashed as they
    stand; fewer words are one shingle.  Each hash falls into the bin of its top bits, and a
    bin keeps its smallest.  An empty bin takes the value of the first filled bin in an order
    of bins that is its own and the same for all texts.  A text without words has every bit
    set.
    """
    kept = [c for c in df.columns if c != out]
    bare = F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))
    w = F.col("_w")
    df = df.select(*kept, once(F.transform(words, lambda x: F.xxhash64(x))).alias("_w"))
    shingles = F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))).otherwise(
        F.filter(F.array(F.xxhash64(w)), lambda _: F.size(w) > 0))
    # One marker a bin, larger than any hash in it: after sorting, the first value of each
    # bin is its smallest hash, or the marker of an empty bin.
    markers = _longs([_signed(b << _REST | _LOW) for b in range(BINS)])
    df = df.select(*kept, once(F.sort_array(F.concat(shingles, markers))).alias("_s"))

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, _REST)

    first = F.filter("_s", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col("_s"), i - 1))))
    df = df.select(*kept, once(first).alias("_d"))

    def filled(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_LOW)) != _LOW

    places = F.filter(F.transform("_d", lambda x, b: F.when(filled(x), b)), lambda b: b.isNotNull())
    df = df.select(*kept, "_d", once(places).alias("_p"))
    probes = _longs([_mix(i * PROBES + j) % BINS for i in range(BINS) for j in range(PROBES)])

    def borrowed(i: Column) -> Column:
        near = F.filter(F.transform(F.slice(probes, i * PROBES + 1, PROBES),
                                    lambda p: F.get(F.col("_d"), p.cast("int"))), filled)
        rank = F.array_min(F.transform("_p", lambda b: F.struct(F.xxhash64(i, b).alias("r"), b.alias("b"))))
        return F.coalesce(F.get(near, F.lit(0)), F.get(F.col("_d"), rank["b"]))

    dense = F.when(F.size("_p") > 0, F.transform(
        "_d", lambda x, i: F.when(filled(x), x).otherwise(borrowed(i)))).otherwise(F.col("_d"))
    df = df.select(*kept, once(dense).alias("_f"))
    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), lambda k: F.aggregate(
        F.slice("_f", k * _PER_LONG + 1, _PER_LONG), F.lit(0).cast("long"),
        lambda acc, x: F.shiftleft(acc, LOW_BITS).bitwiseOR(x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))))
    return df.select(*kept, once(packed).alias(out))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints, 0 to 1.

    Equal low bits of unlike values, one in 2 ** ``LOW_BITS`` by chance, are corrected for.
    Two texts without words are alike, one such and another are not.
    """
    def unlike(x: Column, y: Column) -> Column:
        t = x.bitwiseXOR(y)
        for k in range(int(math.log2(LOW_BITS))):
            t = t.bitwiseOR(F.shiftrightunsigned(t, 1 << k))
        return F.bit_count(t.bitwiseAND(F.lit(_ONES)))

    differ = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda acc, x: acc + x)
    chance = 1 / (1 << LOW_BITS)
    rate = (1 - differ / BINS - chance) / (1 - chance)
    none = F.array_repeat(F.lit(-1).cast("long"), BINS // _PER_LONG)
    return F.when(a == b, 1.0).when((a == none) | (b == none), 0.0).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), rate)))


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """Number of sorted ``bounds`` up to ``key``, by two short searches."""
    if not bounds:
        return F.lit(0)
    fan = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[k:k + fan] for k in range(0, len(bounds), fan)]

    def upto(values: Column) -> Column:
        return F.size(F.filter(values, lambda t: t <= key))

    tops = upto(_longs([g[0] for g in groups]))
    nested = F.expr("array(" + ",".join("array(" + ",".join(f"{v}L" for v in g) + ")" for g in groups) + ")")
    inner = F.coalesce(upto(F.get(nested, tops - 1)), F.lit(0))
    return F.when(tops == 0, 0).otherwise((tops - 1) * fan + inner)


def with_next(df: DataFrame, keys: DataFrame, key: str, tie: str, columns: dict[str, str],
              rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """Add to each row the ``columns`` (name: new name) of the next by (``key``, ``tie``).

    ``keys`` holds the same keys without what is computed in ``df``: it is read to count
    them and to find the bounds.  After the last comes the first.  Rows go to buckets of neighbouring keys, bounded by
    quantiles; the first rows of a bucket also go to the one before it, where they follow the
    last.  The whole rows are shuffled once and no task holds more than a bucket.
    """
    count = keys.count()
    n = min(MOST_BUCKETS, max(1, math.ceil(count / rows_a_bucket)))
    bounds: list[int] = []
    if n > 1:
        shares = F.expr("array(" + ",".join(f"{k / n}D" for k in range(1, n)) + ")")
        bounds = sorted(set(keys.agg(F.percentile_approx(key, shares, max(10_000, 4 * n))).first()[0]))
    bucket = range_bucket(F.col(key), bounds)
    order = Window.orderBy("_b")  # over one row a bucket
    first = keys.select(F.col(key).alias("_key"), bucket.alias("_b")).groupBy("_b").agg(F.min("_key").alias("_first"))
    back = first.select("_first", F.coalesce(
        F.lag("_b").over(order), F.max("_b").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"))
    # at most MOST_BUCKETS rows of two numbers
    met = df.withColumn("_b", bucket).join(F.broadcast(back), F.col(key) == F.col("_first"), "left")
    place = F.explode(F.when(F.col("_before").isNull(), F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("g"))))
                      .otherwise(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("g")),
                                         F.struct(F.col("_before").alias("b"), F.lit(1).alias("g")))))
    placed = met.select(*df.columns, place.alias("_at")).select(*df.columns, "_at.b", "_at.g")
    window = Window.partitionBy("b").orderBy("g", key, tie)
    return placed.select(*df.columns, "g", *[F.lead(c).over(window).alias(name) for c, name in columns.items()]
                         ).where("g = 0").drop("g")


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited form, and three likenesses.

    Nulls and odd input: a null text is empty; null ids come first; rows that share an id
    follow each other by text; a single row is its own next; other columns are not read; an
    empty table gives an empty result.
    """
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(with_fingerprint(docs, "text", "fp"), docs.select("key"), "key", "text", {"text": "next_text", "fp": "next_fp"})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    both = with_fingerprint(pairs, "edited", "edited_fp")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
