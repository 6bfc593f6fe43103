"""Quality classifier: a convolutional network over the bytes of whole documents, in numpy.

Bytes have learned vectors, filters run over every eight neighbouring bytes, and each chunk of
256 bytes, half of which the next chunk shares, keeps every filter's maximum.  A small layer
judges each chunk; a document is what its chunks' judgements are on average and at most, which
the last layer combines into one probability.  The network learns by backpropagation, in a Spark
task, from a bounded sample of the labelled documents; every document is scored where it is read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm.common import crc_mod, materialize, read_table, slices

SAMPLE = 2048           # labelled documents of each label that the network learns from at most
LONGEST = 1 << 16       # bytes of a document of the sample at most; longer ones are scored all the same
WIDTH = 8               # bytes that a filter looks at
VECTOR = 8
FILTERS = 32
HALF = 128              # half a chunk
JUDGED = 16             # values that a chunk is judged by
EPOCHS = 10
BATCH = 16              # documents in a step of learning
RATE = 0.004
SEGMENT = 1 << 18       # bytes that are worked on at once
THRESHOLD = 0.7
PAD = 256               # stands behind the last byte


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"E": (257, VECTOR), "W": (WIDTH * VECTOR, FILTERS), "b": (FILTERS,), "H": (FILTERS, JUDGED), "c": (JUDGED,),
              "v": (2 * JUDGED,), "o": (1,)}
    scale = {"E": 0.5, "W": (WIDTH * VECTOR) ** -0.5, "H": FILTERS ** -0.5, "v": 0.1}
    return {k: rng.normal(0, scale[k], s).astype(np.float32) if k in scale else np.zeros(s, np.float32)
            for k, s in shapes.items()}


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """Bytes of several texts side by side: (codes, text numbers, half chunks of each).

    A text is filled up with ``PAD`` to whole half chunks, with at least WIDTH - 1 of it.  A long
    one comes in segments, each with the WIDTH - 1 bytes after it, so that no window is lost.
    """
    held: list[np.ndarray] = []
    who: list[int] = []
    count: list[int] = []
    for k, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        for at in range(0, max(1, len(data)), SEGMENT):
            last = at + SEGMENT >= len(data)
            n = len(data) - at if last else SEGMENT
            size = -(-(n + (WIDTH - 1 if last else 0)) // HALF) * HALF
            codes = np.full(size + (0 if last else HALF), PAD, np.int16)
            some = data[at:at + n + (0 if last else WIDTH - 1)]
            codes[:len(some)] = some
            if held and sum(map(len, held)) + len(codes) > 2 * SEGMENT:
                yield np.concatenate(held), who, count
                held, who, count = [], [], []
            held.append(codes)
            who.append(k)
            count.append(len(codes) // HALF)
    if held:
        yield np.concatenate(held), who, count


class Network:
    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    def windows(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """The filters' values, rows of windows that start at 0, 8, ..., then at 1, 9, ... and so
        on; windows that would reach beyond a text's end (``ends``) are left out of any maximum."""
        vectors = self.p["E"][np.concatenate([codes, np.full(WIDTH, PAD, np.int16)])].ravel()
        rows = len(codes) // WIDTH
        for k in range(WIDTH):
            out = vectors[k * VECTOR:(k + rows * WIDTH) * VECTOR].reshape(rows, WIDTH * VECTOR) @ self.p["W"]
            if k:
                out[ends // WIDTH - 1] = -np.inf
            yield out

    def halves(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Every filter's largest value in each half chunk."""
        most = None
        for out in self.windows(codes, ends):
            most = out if most is None else np.maximum(most, out, out=most)
        return most.reshape(-1, HALF // WIDTH, FILTERS).max(axis=1)

    def judge(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pooled = np.maximum(chunks + self.p["b"], 0)
        return pooled, np.maximum(pooled @ self.p["H"] + self.p["c"], 0)

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """The log-odds of each text."""
        total = np.zeros((len(texts), JUDGED))
        most = np.zeros((len(texts), JUDGED), np.float32)
        n = np.zeros(len(texts), np.int64)
        open_: tuple[int, np.ndarray] | None = None  # a text that goes on, and its last half chunk
        left = [max(1, -(-len(t) // SEGMENT)) for t in texts]
        for codes, who, count in segments(texts):
            half = self.halves(codes, np.cumsum(count) * HALF)
            for k, part in zip(who, np.split(half, np.cumsum(count)[:-1])):
                left[k] -= 1
                if left[k]:
                    part = part[:-1]  # holds nothing but what the next segment begins with
                if open_ is not None and open_[0] == k:
                    part = np.concatenate([open_[1], part])
                open_ = (k, part[-1:]) if left[k] else None
                if len(part) == 1 and left[k]:
                    continue
                chunks = np.maximum(part[:-1], part[1:]) if len(part) > 1 else part
                judged = self.judge(chunks)[1]
                total[k] += judged.sum(axis=0)
                most[k] = np.maximum(most[k], judged.max(axis=0))
                n[k] += len(judged)
        return np.concatenate([total / np.maximum(n, 1)[:, None], most], axis=1) @ self.p["v"] + self.p["o"][0]

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of texts that fit into one segment each."""
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        parts = list(segments(texts))
        codes = np.concatenate([c for c, _, _ in parts])
        count = np.array([n for _, _, part in parts for n in part])
        ends = np.cumsum(count) * HALF
        values = np.stack(list(self.windows(codes, ends)))
        best = values.argmax(axis=0)
        value = np.take_along_axis(values, best[None], 0)[0].reshape(-1, HALF // WIDTH, FILTERS)
        row = value.argmax(axis=1)
        half = np.take_along_axis(value, row[:, None], 1)[:, 0]
        row += (np.arange(len(half)) * (HALF // WIDTH))[:, None]
        place = row * WIDTH + np.take_along_axis(best, row, 0)  # where the window of each maximum starts

        firsts = np.cumsum(count) - count
        doc = np.repeat(np.arange(len(count)), np.maximum(count - 1, 1))
        left = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(count - 1, 1)) - np.maximum(count - 1, 1), np.maximum(count - 1, 1)) + firsts[doc]
        right = np.where(count[doc] > 1, left + 1, left)
        second = half[right] > half[left]
        chunks = np.where(second, half[right], half[left])
        source = np.where(second, right[:, None], left[:, None])
        pooled, judged = self.judge(chunks)

        begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        number = np.diff(np.append(begin, len(doc)))
        mean = np.add.reduceat(judged, begin, axis=0) / number[:, None]
        most = np.maximum.reduceat(judged, begin, axis=0)
        both = np.concatenate([mean, most], axis=1)
        d = (1 / (1 + np.exp(-(both @ self.p["v"] + self.p["o"][0]))) - labels).astype(np.float32) / len(texts)
        grads["v"], grads["o"] = both.T @ d, d.sum(keepdims=True)
        dboth = d[:, None] * self.p["v"]
        djudged = (dboth[:, :JUDGED] / number[:, None])[doc]
        top = judged == most[doc]
        shared = np.add.reduceat(top, begin, axis=0, dtype=np.float32)
        djudged += np.where(top, (dboth[:, JUDGED:] / shared)[doc], 0)
        djudged *= judged > 0
        grads["H"], grads["c"] = pooled.T @ djudged, djudged.sum(axis=0)
        dpooled = (djudged @ self.p["H"].T) * (pooled > 0)
        grads["b"] = dpooled.sum(axis=0)

        dhalf = np.zeros_like(half)
        column = np.broadcast_to(np.arange(FILTERS), source.shape)
        np.add.at(dhalf, (source, column), dpooled)
        at, f = np.nonzero(dhalf)
        window = np.concatenate([codes, np.full(WIDTH, PAD, np.int16)])[place[at, f][:, None] + np.arange(WIDTH)]
        g = dhalf[at, f]
        order = np.argsort(f, kind="stable")
        window, g, f = window[order], g[order], f[order]
        edge = np.searchsorted(f, np.arange(FILTERS + 1))
        dE = grads["E"]
        for k in range(FILTERS):
            lo, hi = edge[k], edge[k + 1]
            if hi > lo:
                w = window[lo:hi]
                grads["W"][:, k] = g[lo:hi] @ self.p["E"][w].reshape(hi - lo, -1)
                filt = self.p["W"][:, k].reshape(WIDTH, VECTOR)
                for j in range(WIDTH):
                    dE += np.bincount(w[:, j], g[lo:hi], 257)[:, None].astype(np.float32) * filt[j]
        return grads


def learn(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Parameters by Adam over ``epochs`` passes, both labels weighing alike in the sample."""
    net = Network(initial())
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    rng = np.random.default_rng(5)
    step, steps = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in net.gradients([texts[i] for i in some], labels[some]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)
    return net.p


def sampled(docs: DataFrame, known: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> DataFrame:
    """(text, quality): of each label the ``sample`` documents whose ids have the smallest hashes,
    of at most ``longest`` bytes; ``known`` has one label an id.  At most 2 * ``sample`` rows are
    broadcast, and as many of that length come out, in order, however many rows share an id."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("quality = 0").orderBy(*order).limit(sample).union(known.where("quality = 1").orderBy(*order).limit(sample))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).where(F.octet_length("text") <= longest)
    return texts.join(F.broadcast(chosen), "doc_id").orderBy(*order, F.sha2("text", 256)).limit(2 * sample).select("text", "quality")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> dict[str, np.ndarray]:
    """Parameters learned from ``docs`` (doc_id, text) with ``labels`` (doc_id, quality).

    One task learns from the bounded sample; a document with several labels has the lowest.  The
    share of the labels among all labelled ids sets the last layer's constant.
    """
    known = materialize(labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")), "quality-labels")
    share = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        marks: list[int] = []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            marks += batch.column("quality").to_pylist()
        label = np.array(marks, np.float32)
        params = learn(texts, label) if len(texts) else initial()
        ones = float(label.sum())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(params)], pa.binary()), pa.array([ones]),
                                          pa.array([len(texts) - ones])], names=["params", "ones", "zeros"])

    found = sampled(docs, known, sample, longest).coalesce(1).mapInArrow(run, "params binary, ones double, zeros double").first()
    if found is None or not share:
        params = initial()
        params["v"][:] = 0
        return params
    params = pickle.loads(found["params"])
    if not (found["ones"] and found["zeros"]):  # nothing to tell apart
        params["v"][:], params["o"][:] = 0, 0
    else:
        params["o"] -= np.log((found["ones"] + 1) / (found["zeros"] + 1))
    params["o"] += np.log((share.get(1, 0) + 1) / (share.get(0, 0) + 1))
    return {k: v.astype(np.float32) for k, v in params.items()}


def score_quality(docs: DataFrame, params: dict[str, np.ndarray]) -> DataFrame:
    """The input's rows in a struct ``row``, with ``score``, the probability of label 1.

    Nulls and odd input: a null text is empty, and an empty one is a chunk of padding with its
    own score; with no label to learn from every score is one half, with one label alone all
    documents have its share; nothing but the text is looked at, so repeated rows score alike;
    a text of any length is read whole, segment by segment; other columns are carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(shared.value)
        for batch in slices(batches, 256):
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            score = 1 / (1 + np.exp(-np.clip(net.logits(texts), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score, pa.float64())], names=["row", "score"])

    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("binary").alias("text"))
    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, score double")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = crc_mod(F.col("doc_id"), 4) == 2
    params = train(docs, labels.where(~held))
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    return score_quality(rows, params).select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
