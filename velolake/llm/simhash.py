"""SimHash near-dedup: fingerprints of word shingles, linked by a binary trie self-join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm.common import materialize, read_table, slices, word_blocks
from velolake.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
FRONTIER = 1 << 20  # node pairs held at once; more are worked off part by part

_BIT = np.array([[(v >> (7 - k)) & 1 for k in range(8)] for v in range(256)], dtype=np.int64)


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint: a bit is 1 if it is set in over half of the shingle hashes.

    Words are ASCII-lower-cased and split at ASCII white space; fewer words than a shingle
    holds are one shingle, no word gives 0.
    """
    counts = np.zeros((8, 256), dtype=np.int64)
    column = np.arange(8) * 256
    n = 0
    carry: list[bytes] = []
    digest = xxhash.xxh64_digest

    def add(digests: list[bytes]) -> None:
        nonlocal n, counts
        n += len(digests)
        h = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
        counts += np.bincount((h + column).ravel(), minlength=2048).reshape(8, 256)

    for words in word_blocks((text or b"").lower()):
        words = carry + words
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
            add([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())])
            carry = words[len(words) - shingle + 1:]
        else:
            carry = words
    if n == 0:
        if not carry:
            return 0
        add([digest(b" ".join(carry), SEED)])
    ones = (counts[:, :, None] * _BIT).sum(axis=1).ravel()
    return int("".join("1" if 2 * c > n else "0" for c in ones), 2)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``fp`` (the fingerprint as a signed long) of every row; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [simhash(t.as_py(), shingle) for t in batch.column("text")]
            fp = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(fp)], names=[*carry, "fp"])

    plain = docs.select(*carry, F.col("text").cast("binary").alias("text"))
    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return plain.mapInArrow(run, f"{fields}, fp bigint")


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """The 64 bits, cut into ``max_bits`` + 1 blocks of (first bit from the top, width)."""
    cut = [round(64 * k / (max_bits + 1)) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _rotated(values: np.ndarray, left: int) -> np.ndarray:
    left %= 64
    return values if left == 0 else (values << np.uint64(left)) | (values >> np.uint64(64 - left))


def node_pairs(values: np.ndarray, depth: int, cell: int, split_bits: int) -> tuple[np.ndarray, ...]:
    """Where a traversal of sorted ``values`` starts: (depth, ranges of both nodes, cost).

    A negative ``cell`` is every node of ``depth`` against itself.  Another one names two
    nodes ``split_bits`` levels below each node of ``depth``.
    """
    if cell < 0:
        top = values >> np.uint64(64 - depth) if depth else np.zeros(len(values), np.uint64)
        edge = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1], [True])))
        return depth, edge[:-1], edge[1:], edge[:-1], edge[1:], np.zeros(len(edge) - 1, np.int64)
    below = values >> np.uint64(64 - depth - split_bits)
    top = np.unique(below >> np.uint64(split_bits)) << np.uint64(split_bits)
    one, two = divmod(cell, 1 << split_bits)
    ranges = [np.searchsorted(below, top | np.uint64(node), side) for node in (one, two) for side in ("left", "right")]
    cost = np.full(len(top), (one ^ two).bit_count(), np.int64)
    live = (ranges[1] > ranges[0]) & (ranges[3] > ranges[2])
    return depth + split_bits, *(x[live] for x in (*ranges, cost))


def trie_pairs(values: np.ndarray, start: tuple, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct ``values`` that differ in 1 to ``max_bits`` bits.

    ``values`` is the leaf level of a binary trie: a node at depth t is a range of values
    that agree in their first t bits.  Pairs of nodes are taken down together from those of
    ``start``; going to unlike children costs one bit, and a pair over budget is pruned.  A
    pair of single leaves is settled at once.
    """
    stack = [start]
    while stack:
        t, alo, ahi, blo, bhi, cost = stack.pop()
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = (np.bitwise_count(values[i] ^ values[j]) <= max_bits) & (i != j)
            if near.any():
                yield i[near], j[near]
            rest = ~single
            alo, ahi, blo, bhi, cost = alo[rest], ahi[rest], blo[rest], bhi[rest], cost[rest]
        if t == 64 or not len(alo):
            continue
        if len(alo) > FRONTIER:
            for at in range(0, len(alo), FRONTIER):
                part = slice(at, at + FRONTIER)
                stack.append((t, alo[part], ahi[part], blo[part], bhi[part], cost[part]))
            continue

        def middle(node_lo: np.ndarray) -> np.ndarray:
            high = values[node_lo] & ~np.uint64((1 << (64 - t)) - 1)
            return np.searchsorted(values, high | np.uint64(1 << (63 - t)))

        amid = np.clip(middle(alo), alo, ahi)
        bmid = np.clip(middle(blo), blo, bhi)
        same = alo == blo
        child = [(alo, amid, blo, bmid, cost), (amid, ahi, bmid, bhi, cost), (alo, amid, bmid, bhi, cost + 1)]
        apart = ~same
        child.append((amid[apart], ahi[apart], blo[apart], bmid[apart], cost[apart] + 1))
        parts = []
        for a0, a1, b0, b1, c in child:
            live = (a1 > a0) & (b1 > b0) & (c <= max_bits) & ~((a0 == b0) & (a1 - a0 == 1))
            parts.append([x[live] for x in (a0, a1, b0, b1, c)])
        stack.append((t + 1, *(np.concatenate(x) for x in zip(*parts))))


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of index pairs; ``parent`` points every index to the smallest of its set."""
    while True:
        ri, rj = parent[i], parent[j]
        open_ = ri != rj
        if not open_.any():
            return parent
        i, j, ri, rj = i[open_], j[open_], ri[open_], rj[open_]
        np.minimum.at(parent, np.maximum(ri, rj), np.minimum(ri, rj))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, hot: int = 1 << 15,
                      split_bits: int = 8) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints linked at ``max_bits`` bits.

    ``prints`` holds distinct ``fp``.  Two prints within the budget agree in one of
    ``max_bits`` + 1 blocks, so the trie is built once for each rotation that puts a block
    on top, and the subtree below a top block is one unit of work: a print is sent to
    ``max_bits`` + 1 places whatever the number of documents.  A subtree with over ``hot``
    prints is cut further into the pairs of its nodes ``split_bits`` levels down that are
    within the budget, each its own unit.  Within a unit only a spanning set of the links
    goes out, so a dense group costs no more rows than it has prints.
    """
    cut = blocks(max_bits)

    def rotate(first: int):
        return F.col("fp") if first == 0 else F.shiftleft("fp", first).bitwiseOR(
            F.shiftrightunsigned("fp", 64 - first))

    places = prints.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("rot"), rotate(first).alias("v"),
                 F.shiftrightunsigned(rotate(first), 64 - width).alias("top"))
        for r, (first, width) in enumerate(cut)])).alias("p")).select("p.*")
    heavy = places.groupBy("rot", "top").count().where(F.col("count") > hot).select(
        "rot", "top", F.lit(True).alias("heavy"))
    n = 1 << split_bits
    near = [x for x in range(n) if x.bit_count() <= max_bits]
    width = F.element_at(F.array(*[F.lit(w) for _, w in cut]), F.col("rot") + 1)
    node = F.expr(f"cast(shiftrightunsigned(shiftleft(v, w), {64 - split_bits}) as int)")
    other = F.transform(F.array(*map(F.lit, near)), lambda x: node.bitwiseXOR(x))
    cells = places.join(heavy, ["rot", "top"], "left").withColumn("w", width).withColumn(
        "cell", F.explode(F.when(F.col("heavy"), F.transform(
            other, lambda o: F.least(node, o) * n + F.greatest(node, o))).otherwise(F.array(F.lit(-1)))))
    units = cells.select("rot", "top", "cell", "v").repartition("rot", "top", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rot, cell, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in got])
                        for k in ("rot", "cell", "v"))
        v = v.view(np.uint64)
        for r, (first, w) in enumerate(cut):
            # prints of a heavy subtree come once per cell, and are told apart by the cell
            for c in np.unique(cell[rot == r]):
                values = np.unique(v[(rot == r) & (cell == c)])
                parent = np.arange(len(values))
                start = node_pairs(values, w, int(c), split_bits)
                for i, j in trie_pairs(values, start, max_bits):
                    parent = unite(parent, i, j)
                kid = np.flatnonzero(parent != np.arange(len(values)))
                back = _rotated(values, 64 - first).view(np.int64)
                if len(kid):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(back[kid]), pa.array(back[parent[kid]])], names=["a", "b"])

    return units.mapInArrow(run, "a bigint, b bigint")


def near_groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) of distinct ``fp`` with ``first``, the smallest doc_id that has it."""
    edges = fingerprint_links(prints.select("fp"), max_bits)
    roots = connected_components(edges, "simhash-links")
    linked = roots.join(prints, roots.node == prints.fp).select("fp", "root", "first")
    low = linked.groupBy("root").agg(F.min("first").alias("low"))
    moved = linked.join(low, "root").select("fp", "low")
    # Written, as Spark splits a hot key of a join only if both sides come straight from a shuffle.
    return materialize(prints.join(moved, "fp", "left").select(
        "fp", F.coalesce("low", "first").alias("component_id")), "simhash-groups")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document.

    Nulls and odd input: a null or wordless text has fingerprint zero and links like any
    other; repeated rows give repeated rows; a null doc_id keeps its row and is never the
    smallest id of a component that has another.  An empty table gives an empty result.
    """
    docs = materialize(fingerprints(read_table(spark, sf_dir, "documents")), "simhash-prints")
    groups = near_groups(docs.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return docs.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every component: the row of its smallest doc_id, whole.

    Rows that repeat a doc_id and its text count as one row; the one whose other columns are
    least, as JSON text, stays.  A text of any length is hashed whole.  If all ids of a component are null its smallest text hash
    stays.  The rows' own columns come back in their order, whatever their names.
    """
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("th"))
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    prints = materialize(fingerprints(named, shingle, ("doc_id", "th")), "simhash-keep")
    # nulls last: a row without id stands for its component only if no other row can
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    stay = (near_groups(first).select(F.col("component_id.doc_id").alias("d"),
                                      F.col("component_id.th").alias("t")).distinct())
    kept = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t")), "left_semi")
    others = [F.col("row")[c] for c in docs.columns if c not in ("doc_id", "text")]
    rank = F.to_json(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(others)])) if others else F.lit("")
    return kept.groupBy("doc_id", "th").agg(F.min_by("row", rank).alias("row")).select("row.*")
