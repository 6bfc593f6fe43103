"""LM scoring: a gated recurrent network with a class-factored output, and its unigram base.

Word counts over all training documents are Spark aggregates.  The network is trained by
truncated backpropagation in every task on its share of the training documents, and the
tasks' parameters are averaged.  Whole documents are scored where they are read, the state
carried from window to window; only words too rare for the broadcast list are shuffled, to
meet their counts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm.common import crc_mod, materialize, read_table, slices, word_blocks

TAU = 1e-6           # words of at least this share of all tokens are broadcast: at most 1 / TAU
HEAD = int(1 / TAU)  # most frequent words, each with an output of its own: all that are broadcast
HEAD_CLASSES = 0     # classes of head words; 0: that sum, but at most CLASSES
CLASSES = 32         # or the square root of the number of their parts, if that is more
PARTS = 2.0          # parts of classes, by the sum of the roots of the words' frequencies
TAIL_CLASSES = 8     # classes of all other words, by their last two bytes
HIDDEN = 24
SHARES = 4           # the training documents fall into so many shares; each round learns from one, until all are learned
RATE = 0.2
FIRST, FIRST_WORDS = 1e-5, 1e-8  # Adagrad's sums at the start; a word's gradients are small, as few tokens are that word
STREAMS = 128        # documents that a task learns from side by side at first
STREAMS_MOST = 1024  # they double after each pass over so many, up to this
WINDOW = 16          # steps through which an error is passed back at least; twice as many with most streams
LEARNED = 512        # tokens of a document that are learned from in one stream
RUN_IN = 16          # tokens before later ones of a long document that they start after; divides LEARNED
SCORED = 4096        # documents scored side by side
ROWS = 1 << 11       # tokens whose classes are judged at once
SLICE = 4096         # documents whose tokens a task holds at once
FLUSH = 1 << 19      # different words that a task counts before it passes them on
FAN = 64             # tasks whose changes meet at once; of more, each root of their number
PIECE = 1 << 16      # parameters that are averaged together
TRAINED = "part int, piece int, weight double, flat binary"


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs in ``text`` (binary), over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column("text"):
                for words in word_blocks((text.as_py() or b"").lower()):
                    held.update(words)
                    if len(held) >= FLUSH:
                        yield out()
        if held:
            yield out()

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Numbers(dict):
    """Numbers of words; of any other word -1 and lower, by its tail class."""

    def __missing__(self, word: bytes) -> int:
        return -1 - tail_class(word)


def _runs(weight: np.ndarray, wanted: int, empty: bool = False) -> np.ndarray:
    """Of each place its run, of ``wanted`` runs of about equal weight; without those that
    an item of much weight leaves ``empty``, unless these are to stay."""
    share = (np.cumsum(weight) - weight / 2) / weight.sum()
    run = np.minimum((share * wanted).astype(np.int64), wanted - 1)
    return run if empty else np.unique(run, return_inverse=True)[1]


@dataclass
class Vocabulary:
    """Number 0 is the end of a document, 1 to HEAD are the head words, later numbers other
    broadcast words; all by falling count.  Totals are over all training tokens."""

    words: bytes            # joined by line feeds, which no word contains
    counts: np.ndarray      # by number
    train_tokens: int       # N
    distinct: int           # V
    tail_mass: np.ndarray   # of each tail class: its tokens, its different words, and one

    def __post_init__(self) -> None:
        self.head = min(HEAD, len(self.counts) - 1) + 1
        # Parts of equal sums of the roots of frequencies make the mean width of a token's part least;
        # classes are runs of parts by the same rule.  A part is small, so a token meets few words.
        count = self.counts[:self.head] + 1.0
        root = np.sqrt(count / count.sum())
        self.part = _runs(root, max(1, round(PARTS * root.sum())))
        mass = np.sqrt(np.bincount(self.part, count) / count.sum())
        wanted = HEAD_CLASSES or max(min(round(root.sum()), CLASSES), round(math.sqrt(len(mass))), 1)
        part_class = _runs(mass, wanted, bool(HEAD_CLASSES))
        self.head_classes = HEAD_CLASSES or int(part_class[-1]) + 1
        self.head_class = part_class[self.part]
        edges = np.searchsorted(self.part, np.arange(len(mass) + 1))
        self.words_of = [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]  # of a part
        self.rank = np.arange(self.head) - edges[self.part]
        edges = np.searchsorted(part_class, np.arange(self.head_classes + 1))
        self.parts_of = [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]  # of a class
        self.part_rank = np.arange(len(mass)) - edges[part_class]

    def prepare(self) -> None:
        """The look-up table and the classes of all numbers, in a task."""
        words = self.words.split(b"\n") if self.words else []
        self.number = _Numbers(zip(words, range(1, len(words) + 1)))
        tail = [self.head_classes + tail_class(w) for w in words[self.head - 1:]]
        self.classes = np.concatenate([self.head_class, np.array(tail, np.int64)]).astype(np.int16)
        self.log_count = np.log10(self.counts + 1.0)
        self.log_tail = np.log10(self.tail_mass)

    def read(self, text: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Numbers of the tokens with the end (-1: not broadcast), their classes, rare words."""
        numbers, classes, rare = [], [], []
        for words in word_blocks(text.lower()):
            got = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
            at = np.flatnonzero(got < 0)
            kind = self.classes[got * (got > 0)]
            kind[at] = self.head_classes - 1 - got[at]
            got[at] = -1
            rare += [words[i] for i in at.tolist()]
            numbers.append(got)
            classes.append(kind)
        return (np.concatenate([*numbers, [0]]).astype(np.int32),
                np.concatenate([*classes, self.classes[:1]]).astype(np.int16), rare)


def learn_vocabulary(counts: DataFrame, train_docs: int) -> Vocabulary:
    """From the written table of counts; what is collected has at most 1 / TAU rows."""
    total = counts.agg(F.sum("n"), F.count("n")).first()
    tokens, distinct = (total[0] or 0) + train_docs, total[1] + (train_docs > 0)
    often = counts.where(F.col("n") >= TAU * tokens).orderBy(F.desc("n"), "word").toPandas()
    shape = F.crc32(F.expr("substring(cast(word as binary), -2, 2)")) % TAIL_CLASSES
    head = often["word"][:HEAD].tolist()
    mass = np.ones(TAIL_CLASSES)
    rows = counts.select(shape.cast("int").alias("k"), "n").groupBy("k").agg(F.sum("n"), F.count("n")).collect()
    for k, n, different in rows:
        mass[k] += n + different
    for word, n in zip(head, often["n"][:HEAD]):
        mass[tail_class(word.encode())] -= n + 1
    return Vocabulary("\n".join(often["word"]).encode(), np.concatenate([[train_docs], often["n"].to_numpy(np.int64)]),
                      tokens, distinct, mass)


def _exp(x: np.ndarray) -> np.ndarray | float:
    """Turns logits into their exponentials, all less what is returned: nothing as a rule,
    or each row's largest where the exponentials could leave the range of float32."""
    top = 0.0
    if x.max() > 50 or x.min() < -50:
        top = x.max(axis=1, keepdims=True)
        x -= top
        top = top[:, 0]
    np.exp(x, out=x)
    return top


class Network:
    """Parameters and passes.  Inputs are head words, as vectors of the state's width, and tail
    classes; the output is a class, in a head class a part of it, and in the part a word.  Unlearned, it
    gives the words' plain frequencies.  States lie side by side, a row for each unit."""

    def __init__(self, vocab: Vocabulary, flat: np.ndarray | None = None):
        self.vocab = vocab
        self.streams = STREAMS
        self.inputs = vocab.head + TAIL_CLASSES
        parts = len(vocab.words_of)
        classes = vocab.head_classes + TAIL_CLASSES
        self.shapes = {"E": (self.inputs, HIDDEN), "P": (HIDDEN, 3 * HIDDEN), "U": (HIDDEN, 3 * HIDDEN), "C": (HIDDEN, classes),
                       "c": (classes,), "S": (parts, HIDDEN), "s": (parts,), "W": (vocab.head, HIDDEN), "w": (vocab.head,)}
        if flat is None:
            rng = np.random.default_rng(7)
            self.p = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in self.shapes.items()}
            self.p["P"] *= 2
            for k in "CSW":
                self.p[k][:] = 0
            count = vocab.counts[:vocab.head] + 1.0
            mass = np.concatenate([np.bincount(vocab.head_class, count, vocab.head_classes), vocab.tail_mass])
            self.p["c"][:] = np.log(np.maximum(mass, 1e-3) / mass.sum())
            self.p["s"][:] = np.log(np.bincount(vocab.part, count) / count.sum())
            self.p["w"][:] = np.log(count / count.sum())
        else:
            self.p, at = {}, 0
            for k, s in self.shapes.items():
                n = int(np.prod(s))
                self.p[k] = flat[at:at + n].reshape(s).astype(np.float32)
                at += n

    def squares(self) -> dict[str, np.ndarray]:
        """Adagrad's sums at the start."""
        return {k: np.full(v.shape[:1] if k == "W" else v.shape, FIRST_WORDS if k in "Ww" else FIRST, np.float32)
                for k, v in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.shapes])

    def inputs_of(self, numbers: np.ndarray, classes: np.ndarray) -> np.ndarray:
        head = (numbers >= 0) & (numbers < self.vocab.head)
        return np.where(head, numbers, self.vocab.head - self.vocab.head_classes + classes.astype(np.int64))

    def fed(self, x: np.ndarray) -> np.ndarray:
        """What inputs give the gates and the new state."""
        return self.p["P"].T @ self.p["E"][x].T

    def gates(self, e: np.ndarray, h: np.ndarray, out: np.ndarray, new: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The next state; into ``out`` the gates z and r, and into ``new`` and ``u`` what else made it."""
        n = HIDDEN
        full = self.p["U"].T @ h
        np.add(e[:2 * n], full[:2 * n], out=out)
        np.negative(out, out=out)
        np.exp(out, out=out)
        out += 1
        np.reciprocal(out, out=out)
        u[:] = full[2 * n:]
        np.multiply(out[n:], u, out=new)
        new += e[2 * n:]
        np.tanh(new, out=new)
        after = h - new
        after *= out[:n]
        after += new
        return after

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step of rows of states: the next ones, and what made them."""
        kept = [np.empty((k, len(h)), h.dtype) for k in (2 * HIDDEN, HIDDEN, HIDDEN)]
        return self.gates(self.fed(x), h.T, *kept).T, *kept

    def inside(self, h: np.ndarray, group: np.ndarray, rank: np.ndarray, runs: list[slice], names: str, out: np.ndarray,
               scale: float = 0, learn: Callable[[slice, np.ndarray, np.ndarray], None] | None = None,
               together: list[slice] | None = None) -> np.ndarray | None:
        """Adds to ``out`` the log probability of ``rank`` within its run of the rows of two parameters;
        tokens stand by ``group``, the run.  With ``learn`` also the gradient in ``h``, and ``learn``
        gets that in the rows of several runs, ``together``, once they are done with."""
        weights, single = self.p[names[0]], self.p[names[1]]
        found, total, shift = np.zeros(len(h), h.dtype), np.ones(len(h), h.dtype), np.zeros(len(h), h.dtype)
        down = np.zeros_like(h) if learn else None
        edge = np.searchsorted(group, np.arange(len(runs) + 1)).tolist()
        widest = max(r.stop - r.start for r in runs)
        ones, places = np.ones(widest, h.dtype), np.arange(len(h))
        for some in together or [slice(k, k + 1) for k in range(len(runs))]:
            lo, hi = edge[some.start], edge[some.stop]
            if lo == hi:
                continue
            span = slice(runs[some.start].start, runs[some.stop - 1].stop)
            if learn:
                dW, dw = np.zeros((span.stop - span.start, HIDDEN), h.dtype), np.zeros(span.stop - span.start, h.dtype)
            for k in range(some.start, some.stop):
                lo, hi, run = edge[k], edge[k + 1], runs[k]
                width = run.stop - run.start
                if lo == hi or width < 2:
                    continue
                weight, rows = weights[run], h[lo:hi]
                x = rows @ weight.T
                x += single[run]
                at = places[:hi - lo] * width + rank[lo:hi]
                flat = x.reshape(-1)
                found[lo:hi] = flat[at]
                shift[lo:hi] = _exp(x)
                all_ = total[lo:hi] = x @ ones[:width]
                if learn:
                    flat[at] -= all_
                    part = scale / all_
                    np.multiply(x @ weight, part[:, None], out=down[lo:hi])
                    here = slice(run.start - span.start, run.stop - span.start)
                    np.matmul(x.T, rows * part[:, None], out=dW[here])
                    np.matmul(part, x, out=dw[here])
            if learn:
                learn(span, dW, dw)
        out += found - shift - np.log(total)
        return down

    def output(self, h: np.ndarray, target: np.ndarray, kind: np.ndarray, grads: dict | None = None,
               learn: Callable[[slice, np.ndarray, np.ndarray], None] | None = None):
        """Natural log probability of each target (class, and where it is a head word its part and
        the word); with ``grads`` also the gradient of the mean loss in ``h``, and ``learn`` gets that
        in W and w of the words of each class met, once the class is done with."""
        scale = 1 / max(1, len(h))
        out = np.zeros(len(h))
        dh = None if grads is None else np.zeros_like(h)
        ones = np.ones(len(self.p["c"]), h.dtype)
        for lo in range(0, len(h), ROWS):
            some = slice(lo, lo + ROWS)
            rows = h[some]
            x = rows @ self.p["C"]
            x += self.p["c"]
            at = np.arange(len(x)) * x.shape[1] + kind[some]
            flat = x.reshape(-1)
            found = flat[at]
            shift = _exp(x)
            total = x @ ones
            out[some] = found - shift - np.log(total)
            if grads is not None:
                flat[at] -= total
                x *= (scale / total)[:, None]
                grads["C"] += rows.T @ x
                grads["c"] += x.sum(axis=0)
                dh[some] = x @ self.p["C"].T
        vocab = self.vocab
        order = np.argsort(np.where(kind < vocab.head_classes, target, vocab.head))
        order = order[:int((kind < vocab.head_classes).sum())]  # without tail classes
        h, target = h[order], target[order]
        part, got = vocab.part[target], np.zeros(len(order), h.dtype)

        def learn_parts(parts: slice, dS: np.ndarray, ds: np.ndarray) -> None:
            grads["S"][parts] += dS
            grads["s"][parts] += ds

        down = self.inside(h, vocab.head_class[target], vocab.part_rank[part], vocab.parts_of, "Ss", got, scale,
                           None if grads is None else learn_parts)
        more = self.inside(h, part, vocab.rank[target], vocab.words_of, "Ww", got, scale,
                           None if grads is None else learn, vocab.parts_of)
        out[order] += got
        if grads is not None:
            down += more
            dh[order] += down
        return out, dh

    def feed(self, numbers: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """A document's inputs: at each token the one before it."""
        return np.concatenate([[0], self.inputs_of(numbers, classes)[:-1]])

    def windows(self, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int, least: int) -> Iterator[tuple]:
        """Windows over documents (numbers, classes, inputs) that stand by falling length: (documents still open at each
        step, inputs, targets, classes), these three step by step.  A window has ``width``
        steps, or more where few documents are left, for ``least`` tokens."""
        lens = np.array([len(d[0]) for d in docs])
        t = span = 0
        while (t := t + span) < lens[0]:
            some = int((lens > t).sum())
            span = min(max(width, least // some), int(lens[0]) - t)
            x, y, k = (np.zeros((span, some), np.int64) for _ in range(3))
            for i in range(some):
                n = min(span, lens[i] - t)
                x[:n, i], y[:n, i], k[:n, i] = docs[i][2][t:t + n], docs[i][0][t:t + n], docs[i][1][t:t + n]
            there = lens[:some] > t + np.arange(span)[:, None]
            yield there.sum(axis=1).tolist(), x[there], y[there], k[there]

    def forward(self, open_: list[int], e: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """Through one window: the last states of the documents open at its end, and of all tokens
        side by side the states, the gates and what else made them."""
        size, at = e.shape[1], 0
        seen, new, u = (np.empty((HIDDEN, size), np.float32) for _ in range(3))
        gates = np.empty((2 * HIDDEN, size), np.float32)
        for m in open_:
            some = slice(at, at + m)
            h = self.gates(e[:, some], h[:, :m], gates[:, some], new[:, some], u[:, some])
            seen[:, some] = h
            at += m
        return h, seen, gates, new, u

    def score(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Natural log probability of whole documents, without the words of tail classes."""
        out = np.zeros(len(docs))
        by_length = sorted(range(len(docs)), key=lambda i: -len(docs[i][0]))
        for lo in range(0, len(docs), SCORED):
            part = by_length[lo:lo + SCORED]
            some = [(*docs[i], self.feed(*docs[i])) for i in part]
            h = np.zeros((HIDDEN, len(part)), np.float32)
            for open_, x, target, kind in self.windows(some, WINDOW, 1 << 16):
                h, seen, *_ = self.forward(open_, self.fed(x), h)
                got, _ = self.output(np.ascontiguousarray(seen.T), target, kind)
                doc = np.concatenate([np.arange(n) for n in open_])
                out[part] += np.bincount(doc, got, len(part))
        return out

    def train(self, docs: list[tuple[np.ndarray, np.ndarray]], squares: dict[str, np.ndarray]) -> None:
        """One pass over the documents: truncated backpropagation, a step of Adagrad a window.
        Long documents are learned from in pieces side by side; each starts from the state after
        the tokens just before it."""
        n = HIDDEN

        def learn(words: slice, dW: np.ndarray, dw: np.ndarray) -> None:
            sums, single = squares["W"][words], squares["w"][words]
            sums += np.einsum("ij,ij->i", dW, dW) / n  # a word's vector has one sum of squares
            single += dw * dw
            dW *= (RATE / (np.sqrt(sums) + 1e-6))[:, None]
            self.p["W"][words] -= dW
            self.p["w"][words] -= RATE * dw / (np.sqrt(single) + 1e-6)

        pieces_ = []
        for numbers, classes in docs:
            fed = self.feed(numbers, classes)
            for at in range(0, len(fed), LEARNED):
                some = slice(at, at + LEARNED)
                pieces_.append((numbers[some], classes[some], fed[some], fed[max(0, at - RUN_IN):at]))
        pieces_.sort(key=lambda p: -len(p[0]))
        hi = len(pieces_)
        while hi:  # from short to long ones, so that few tokens are learned from in small steps
            streams = self.streams
            part = pieces_[max(0, hi - streams):hi]
            hi = max(0, hi - streams)
            self.streams = max(streams, min(STREAMS_MOST, 2 * streams))
            h = np.zeros((n, len(part)), np.float32)
            later = [i for i, p in enumerate(part) if len(p[3])]
            if later:
                before = np.stack([part[i][3] for i in later], axis=1)
                h[:, later] = self.forward([len(later)] * len(before), self.fed(before.ravel()), h[:, later])[0]
            width = WINDOW << (streams >= STREAMS_MOST)
            for open_, fed, target, kind in self.windows(part, width, width * streams):
                vectors = self.p["E"][fed]
                at = np.cumsum([0, *open_]).tolist()
                first = h[:, :open_[0]]
                h, seen, gates, new, u = self.forward(open_, self.p["P"].T @ vectors.T, first)
                grads = {name: np.zeros_like(self.p[name]) for name in "PUCcSs"}
                dout = np.ascontiguousarray(self.output(np.ascontiguousarray(seen.T), target, kind, grads, learn)[1].T)
                dh = np.zeros((n, open_[0]), np.float32)
                rows = np.empty((3 * n, at[-1]), np.float32)
                for s in range(len(open_) - 1, -1, -1):
                    m, some = open_[s], slice(at[s], at[s + 1])
                    before = seen[:, at[s - 1]:at[s - 1] + m] if s else first
                    z, r, made = gates[:n, some], gates[n:, some], new[:, some]
                    d = dh[:, :m]
                    d += dout[:, some]
                    down = np.empty((3 * n, m), np.float32)  # for z, r and the new state's other part
                    dz, dr, dnew = down[:n], down[n:2 * n], d * z
                    np.multiply(before - made, d - dnew, out=dz)
                    dz *= z
                    by = d - dnew
                    d[:] = dnew
                    np.multiply(made, made, out=dr)
                    np.subtract(1, dr, out=dr)
                    by *= dr
                    rows[2 * n:, some] = by
                    np.multiply(by, r, out=down[2 * n:])
                    np.multiply(down[2 * n:], u[:, some], out=dr)
                    dr *= 1 - r
                    rows[:2 * n, some] = down[:2 * n]
                    grads["U"] += before @ down.T
                    d += self.p["U"] @ down
                grads["P"] += vectors.T @ rows.T
                rows = rows.T @ self.p["P"].T
                order = np.argsort(fed)
                first = np.flatnonzero(np.diff(fed[order], prepend=-1))
                used = fed[order[first]]
                summed = np.add.reduceat(rows[order], first, axis=0)
                squares["E"][used] += summed * summed
                self.p["E"][used] -= RATE * summed / (np.sqrt(squares["E"][used]) + 1e-6)
                for name, g in grads.items():
                    squares[name] += g * g
                    self.p[name] -= RATE * g / (np.sqrt(squares[name]) + 1e-6)


def pieces(part: int, weight: float, change: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task learned, as ``average`` takes it: the pieces of the parameters that changed, in
    16 bits, and a row with the weight alone."""
    rows = [(part, -1, weight, b"")]
    for piece, at in enumerate(range(0, len(change), PIECE)):
        some = change[at:at + PIECE].astype(np.float16)
        if some.any():
            rows.append((part, piece, weight, some.tobytes()))
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.float64(), pa.binary()))],
                                         names=["part", "piece", "weight", "flat"])


def average(trained: DataFrame, size: int, levels: int = 1) -> np.ndarray | None:
    """Mean by ``weight`` of the tasks' changes of ``size`` parameters, each piece by itself: an
    absent piece is no change.  With two levels, tasks of one ``part`` meet first."""
    def add(group: pa.Table) -> pa.Table:
        total, weight = np.zeros(0), 0.0
        for flat, w in zip(group["flat"], group["weight"].to_pylist()):
            part = np.frombuffer(flat.as_py(), np.float16).astype(np.float64) * w
            total = total + part if len(total) else part
            weight += w
        return pa.table({"part": group["part"].slice(0, 1), "piece": group["piece"].slice(0, 1),
                         "weight": [weight], "flat": [(total / weight).astype(np.float16).tobytes()]})

    for level in range(levels):
        keyed = trained if level + 1 < levels else trained.withColumn("part", F.lit(0))
        trained = keyed.groupBy("part", "piece").applyInArrow(add, TRAINED)
    rows = {r["piece"]: r for r in trained.select("piece", "weight", "flat").collect()}
    if not rows:
        return None
    out = np.zeros(size, np.float32)
    for piece, r in rows.items():
        if piece >= 0:
            out[piece * PIECE:(piece + 1) * PIECE] = np.frombuffer(r["flat"], np.float16).astype(np.float32) * (r["weight"] / rows[-1]["weight"])
    return out


def train_network(texts: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Parameters learned from the rows of ``texts`` (text binary, share int).

    In each round every task goes on from the common parameters over the documents of one
    share that it reads, and the mean by tokens is the next common state.  The rounds go
    over all shares, so every document is learned from once.
    """
    sc = texts.sparkSession.sparkContext
    tasks = texts.rdd.getNumPartitions()
    fan, levels = (math.isqrt(tasks), 2) if tasks > FAN else (1, 1)
    flat = Network(vocab).flat()
    words = sc.broadcast(vocab)
    for number in range(SHARES):
        start = sc.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            vocab = words.value
            vocab.prepare()
            net = Network(vocab, start.value)
            squares = net.squares()
            tokens = 0
            for batch in slices(batches, SLICE):
                docs = [vocab.read(t.as_py() or b"")[:2] for t in batch.column("text")]
                tokens += sum(len(n) for n, _ in docs)
                net.train(docs, squares)
            if tokens:
                yield from pieces(TaskContext.get().partitionId() % fan, float(tokens), net.flat() - start.value)

        mean = average(texts.where(F.col("share") == number).select("text").mapInArrow(run, TRAINED), len(flat), levels)
        flat = flat if mean is None else flat + mean
        start.unpersist()
    return flat


def score_documents(docs: DataFrame) -> DataFrame:
    """Base and model scores of every row of ``docs`` (doc_id, text), as the query returns them.

    Nulls and odd input: a null text is empty, its one token the end; a null doc_id counts as
    the empty text where the id decides the fold; repeated rows are counted and scored each;
    other columns are not read; an empty table gives an empty result.  With nothing to train
    on every count is zero.  A text of any length is read whole, in blocks of words.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                       (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int").alias("share"))
    known = rows.where(~F.col("held_out"))
    counts = materialize(count_words(known), "lm-counts")
    vocab = learn_vocabulary(counts, known.count())
    flat = train_network(known, vocab)
    sc = docs.sparkSession.sparkContext
    words, params = sc.broadcast(vocab), sc.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = words.value
        vocab.prepare()
        net = Network(vocab, params.value)
        for batch in slices(batches, SLICE):
            read = [vocab.read(t.as_py() or b"") for t in batch.column("text")]
            model = net.score([r[:2] for r in read]) / np.log(10)
            n_known, base = [], []
            for i, (numbers, classes, _) in enumerate(read):
                seen = numbers[numbers >= 0]
                n_known.append(int((vocab.counts[seen] > 0).sum()))
                base.append(vocab.log_count[seen].sum())
                tail = classes >= vocab.head_classes
                model[i] += vocab.log_count[numbers[tail & (numbers >= 0)]].sum()
                model[i] -= vocab.log_tail[classes[tail].astype(np.int64) - vocab.head_classes].sum()
            rare = pa.array([r[2] for r in read], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([len(r[0]) for r in read], pa.int64()),
                 pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(model, pa.float64()), rare],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = materialize(rows.select("doc_id", "text", "held_out").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<string>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    found = scored.select("row", F.explode("rare").alias("word")).join(counts, "word").groupBy("row").agg(
        F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("log"))
    more, log = F.coalesce("more", F.lit(0)), F.coalesce("log", F.lit(0.0))
    space = float(np.log10(vocab.train_tokens + vocab.distinct + 1))
    return scored.drop("rare").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"),
        F.lit(vocab.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * space).alias("base_score"), (F.col("model") + log).alias("score"))


def op7_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
