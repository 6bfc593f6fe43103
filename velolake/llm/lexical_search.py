"""Ranked lexical search: branch and bound over tries of restricted term vectors.

Of every document only its terms that some item asks for are kept, in the order of falling
document frequency.  A task sorts a block of such vectors into a trie, where vectors that begin
alike share a path.  A subtree is a range of the sorted vectors and knows the largest frequency
of each term and the smallest length norm in it; since a score grows with the one and falls
with the other, the two bound every score below.  Each item goes down depth first, the best
child first, and leaves out what cannot reach its current list; of what remains every document
is scored.  The tasks' lists meet in two levels of ranking.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from velolake.llm.common import materialize, read_table, slices, term_blocks, work_path

LIMIT = 50
BLOCK_TERMS = 1 << 14    # different terms of the items that are broadcast together (one item may have more)
BLOCK_CHARS = 8_000_000  # ... and their text
CELLS = 1 << 24          # frequencies, documents by terms, that a trie's block holds
BLOCK_DOCS = 1 << 13
LEAF = 16                # documents below which a subtree is not divided further
FAN = 256                # groups of tasks whose lists are ranked first
LAST_ID = (1 << 63) - 1  # stands for a null doc_id, after all others


def terms_of(text: str | None) -> list[str]:
    """Different terms of an item, in their order."""
    return [t.decode() for t in dict.fromkeys(t for part in term_blocks((text or "").encode()) for t in part)]


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, object, list[str]]]]:
    """(number, item_id, terms) of every item with a term, in blocks of bounded size."""
    block: list[tuple[int, object, list[str]]] = []
    known: set[str] = set()
    chars = 0
    for number, row in enumerate(items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()):
        terms = terms_of(row["text"])
        if not terms:
            continue
        if block and (len(known.union(terms)) > BLOCK_TERMS or chars + len(row["text"]) > BLOCK_CHARS):
            yield block
            block, known, chars = [], set(), 0
        block.append((number, row["item_id"], terms))
        known.update(terms)
        chars += len(row["text"])
    if block:
        yield block


def restricted(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs): number of all terms of each text, and those of ``vocabulary``
    by place with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t.encode(): i for i, t in enumerate(shared.value, 1)}
        for batch in slices(batches):
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                held: Counter[int] = Counter()
                size = 0
                for part in term_blocks(text.as_py() or b""):
                    size += len(part)
                    held.update(filter(None, map(place.get, part)))
                n.append(size)
                terms += held.keys()
                tfs += held.values()
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def norm(n: int, docs: int, length: int) -> int:
    return 100 - 50 + 50 * n * docs // length


class Trie:
    """Vectors of one block in trie order, and its nodes, children side by side.

    A node is a range of the vectors that share a path; a chain of nodes without branches is
    one node, and neighbouring branches of few vectors are one leaf.
    """

    def __init__(self, ids: np.ndarray, norms: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], width: int):
        path = [np.sort(t).astype(">u4").tobytes() for t, _ in vectors]
        order = sorted(range(len(path)), key=path.__getitem__)
        path = [path[i] for i in order]
        self.ids, self.norms = ids[order], norms[order]
        self.tf = np.zeros((len(order), width), np.int32)
        for row, i in enumerate(order):
            self.tf[row, vectors[i][0]] = vectors[i][1]
        self.lo, self.hi, self.children = [0], [len(order)], [range(0)]
        at = 0
        while at < len(self.lo):
            self.children[at] = self._branch(path, self.lo[at], self.hi[at])
            at += 1
        self.most = np.stack([self.tf[lo:hi].max(axis=0) for lo, hi in zip(self.lo, self.hi)])
        self.least = np.array([self.norms[lo:hi].min() for lo, hi in zip(self.lo, self.hi)])
        self.first = np.array([self.ids[lo:hi].min() for lo, hi in zip(self.lo, self.hi)])

    def _branch(self, path: list[bytes], lo: int, hi: int) -> range:
        """Add the children of the node lo:hi and return their places."""
        if hi - lo <= LEAF or path[lo] == path[hi - 1]:
            return range(0)
        a, b = path[lo], path[hi - 1]
        depth = 0  # sorted, so what the first and the last share all share
        while a[depth:depth + 4] == b[depth:depth + 4]:
            depth += 4
        start = len(self.lo)
        begin = at = lo
        while at < hi:
            step = path[at][depth:depth + 4]
            end = bisect_right(path, step, at, hi, key=lambda p: p[depth:depth + 4])
            if end - begin > LEAF and at > begin:
                self._add(begin, at)
                begin = at
            if end - begin > LEAF:
                self._add(begin, end)
                begin = end
            at = end
        if begin < hi:
            self._add(begin, hi)
        return range(start, len(self.lo))

    def _add(self, lo: int, hi: int) -> None:
        self.lo.append(lo)
        self.hi.append(hi)
        self.children.append(range(0))


def scores(tf: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of rows of frequencies; with largest frequencies and smallest norms, bounds."""
    tf = tf.astype(np.int64)
    return (weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[:, None]))).sum(axis=1)


class Best:
    """The best (score, doc_id) of one item so far."""

    def __init__(self, limit: int):
        self.limit = limit
        self.score = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def can_hold(self, bound: int, first: int) -> bool:
        """Whether a score of at most ``bound`` of ids from ``first`` on may enter."""
        if bound <= 0 or len(self.score) < self.limit:
            return bound > 0
        return bound > self.score[-1] or bound == self.score[-1] and first < self.ids[-1]

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        good = score > 0
        if len(self.score) == self.limit:
            good &= (score > self.score[-1]) | ((score == self.score[-1]) & (ids < self.ids[-1]))
        if good.any():
            score, ids = np.concatenate([self.score, score[good]]), np.concatenate([self.ids, ids[good]])
            order = np.lexsort((ids, -score))[:self.limit]
            self.score, self.ids = score[order], ids[order]


def descend(trie: Trie, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Depth-first branch and bound of one item."""
    stack = [(1 << 62, 0)]
    while stack:
        bound, node = stack.pop()
        if not best.can_hold(bound, trie.first[node]):
            continue
        below = trie.children[node]
        if not below:
            part = slice(trie.lo[node], trie.hi[node])
            best.add(scores(trie.tf[part][:, terms], trie.norms[part], weights), trie.ids[part])
            continue
        part = slice(below[0], below[-1] + 1)
        bounds = scores(trie.most[part][:, terms], trie.least[part], weights)
        for k in np.argsort(bounds, kind="stable").tolist():  # the best child is taken next
            if best.can_hold(int(bounds[k]), trie.first[below[k]]):
                stack.append((int(bounds[k]), below[k]))


def local_lists(vectors: DataFrame, items: list[tuple[int, object, np.ndarray, np.ndarray]], place: np.ndarray,
                docs: int, length: int, limit: int, item_type: DataType) -> DataFrame:
    """(task, number, item_id, doc_id, score): the best documents of each item among each task's
    vectors.  ``place`` gives the rank by document frequency of the numbers in the vectors."""
    kind = to_arrow_type(item_type)
    shared = vectors.sparkSession.sparkContext.broadcast((items, place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, place = shared.value
        lists = [Best(limit) for _ in items]
        width = len(place) - 1
        most = max(64, min(BLOCK_DOCS, CELLS // max(1, width)))
        for batch in slices(batches, most):
            ends = batch.column("terms").offsets.to_numpy()
            base = ends[0]
            terms, tfs = (batch.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
            vectors = [(place[terms[lo:hi]], tfs[lo:hi]) for lo, hi in zip(ends[:-1] - base, ends[1:] - base)]
            ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy()
            norms = np.array([norm(n, docs, length) for n in batch.column("n").to_pylist()], np.int64)
            if len(ids):
                trie = Trie(ids, norms, vectors, width)
                for (_, _, terms_, weights), best in zip(items, lists):
                    descend(trie, terms_, weights, best)
        task = TaskContext.get().partitionId()
        for (number, item, _, _), best in zip(items, lists):
            n = len(best.score)
            ids = pa.array(best.ids, mask=best.ids == LAST_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * n, pa.int32()), pa.array([number] * n, pa.int64()), pa.array([item] * n, kind), ids,
                 pa.array(best.score)], names=["task", "number", "item_id", "doc_id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(
        run, f"task int, number long, item_id {item_type.simpleString()}, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``limit`` best documents of every item, all of ``docs``
    (doc_id, text) held against all of ``items`` (item_id, text), score above 0 only.

    Items are taken in blocks of bounded size; for each, the restricted vectors are written once
    and give the counts and frequencies of the whole table, then the tries.

    Nulls and odd input: a null text has no term, such a document counts nowhere and such an
    item finds nothing; a null doc_id comes last among equal scores; rows that repeat are
    documents and items of their own, each item ranked by itself; a text of any length is read
    whole; other columns are not read; an empty table of either kind gives an empty result.
    """
    spark = docs.sparkSession
    path, found = work_path(spark, "search-lists"), []
    kind = items.schema["item_id"].dataType
    for block in item_blocks(items):
        vocabulary = sorted({t for _, _, terms in block for t in terms})
        vectors = materialize(restricted(docs, vocabulary), "search-vectors")
        n, length = vectors.where(F.col("n") > 0).agg(F.count("*"), F.sum("n")).first()
        if not n:
            continue
        df = np.zeros(len(vocabulary) + 1, np.int64)
        # At most one row a term of the block.
        for term, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = count
        place = np.empty(len(df), np.int64)
        place[np.concatenate([[0], 1 + np.argsort(-df[1:], kind="stable")])] = np.arange(-1, len(df) - 1)
        number = {t: i for i, t in enumerate(vocabulary, 1)}
        asked = []
        for k, item, terms in block:
            at = np.array([number[t] for t in terms])
            asked.append((k, item, place[at], np.array([weight(n, int(d)) for d in df[at]], np.int64)))
        found.append(f"{path}/{len(found)}")
        local_lists(vectors, asked, place, n, length, limit, kind).write.parquet(found[-1])
    if not found:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    rows = reduce(DataFrame.union, [spark.read.parquet(p) for p in found])
    for keys in ([F.col("number"), F.col("task") % FAN], [F.col("number")]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return rows.select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = f"""
WITH texts AS (SELECT doc_id, 0 AS side, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark),
words AS (SELECT doc_id, side, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts),
held AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE side = 0 GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM size),
norms AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // len) AS m FROM size, total),
freq AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, total GROUP BY term),
asked AS (SELECT DISTINCT doc_id AS item_id, term FROM words WHERE side = 1),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM asked JOIN held USING (term) JOIN freq USING (term) JOIN norms USING (doc_id) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {LIMIT}
"""
