import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from velolake.llm import gru_lm as L

SCHEMA = "doc_id long, text string, word string, row int, share int"


def vocabulary(texts, head=6):
    counts = Counter(w for t in texts for w in t.lower().split())
    often = sorted(counts, key=lambda w: (-counts[w], w))
    mass = np.ones(L.TAIL_CLASSES)
    for w in often[head:]:
        mass[L.tail_class(w)] += counts[w] + 1
    v = L.Vocabulary(b"\n".join(often), np.array([len(texts)] + [counts[w] for w in often]),
                     sum(counts.values()) + len(texts), len(counts) + 1, mass)
    v.prepare()
    return v


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(L, "HEAD", 6)
    monkeypatch.setattr(L, "HEAD_CLASSES", 3)
    rng = random.Random(1)
    texts = [b" ".join(rng.choice([b"The", b"a", b"of", b"cat", b"dog", b"sat", b"mat", b"hat", b"ran", b"far"])
                       for _ in range(rng.randrange(0, 60))) for _ in range(20)]
    v = vocabulary(texts)
    net = L.Network(v)
    gen = np.random.default_rng(3)
    for k, p in net.p.items():
        net.p[k] = p + gen.normal(0, 0.3, p.shape)
    return v, net, [v.read(t)[:2] for t in texts]


def plain_score(net, numbers, classes):
    h, total = np.zeros((1, L.HIDDEN)), 0.0
    feeds = np.concatenate([[0], net.inputs_of(numbers, classes)[:-1]])
    for x, y, k in zip(feeds, numbers, classes):
        h = net.step(np.array([x]), h)[0]
        total += net.output(h, np.array([y]), np.array([k]))[0][0]
    return total


def test_windows_carry_the_state(small, monkeypatch):
    v, net, docs = small
    want = [plain_score(net, n, c) for n, c in docs]
    assert net.score(docs) == pytest.approx(want)
    monkeypatch.setattr(L, "WINDOW", 1)
    monkeypatch.setattr(L, "SCORED", 3)
    assert net.score(docs) == pytest.approx(want)


def test_probabilities_sum_to_one(small):
    v, net, _ = small
    h = np.random.default_rng(1).normal(0, 1, (1, L.HIDDEN))
    head = sum(math.exp(net.output(h, np.array([i]), v.classes[[i]])[0][0]) for i in range(v.head))
    tail = [math.exp(net.output(h, np.array([-1]), np.array([L.HEAD_CLASSES + k]))[0][0]) for k in range(L.TAIL_CLASSES)]
    assert head + sum(tail) == pytest.approx(1)
    words = v.words.split(b"\n")
    for k in range(L.TAIL_CLASSES):
        inside = sum(v.counts[i + 1] + 1 for i, w in enumerate(words) if i >= 6 and L.tail_class(w) == k)
        assert inside + 1 == v.tail_mass[k]  # and one for all words never seen


def test_unlearned_network_gives_frequencies(monkeypatch):
    monkeypatch.setattr(L, "HEAD", 3)
    monkeypatch.setattr(L, "HEAD_CLASSES", 2)
    v = vocabulary([b"a a a b b c d"], head=3)
    net = L.Network(v)
    h = np.zeros((1, L.HIDDEN))
    p = [math.exp(net.output(h, np.array([i]), v.classes[[i]])[0][0]) for i in range(v.head)]
    mass = np.array([2, 4, 3, 2])  # end, a, b, c: count and one
    assert p == pytest.approx(mass / (mass.sum() + v.tail_mass.sum()), rel=1e-4)


def test_gradient_of_the_output(small):
    v, net, _ = small
    h = np.random.default_rng(2).normal(0, 1, (9, L.HIDDEN))
    target = np.array([0, 1, 2, 3, 4, 5, 6, -1, -1])
    kind = np.concatenate([v.classes[:7], [L.HEAD_CLASSES, L.HEAD_CLASSES + 2]])
    grads = {k: np.zeros_like(p) for k, p in net.p.items()}

    def learn(words, dW, dw):
        grads["W"][words], grads["w"][words] = dW, dw

    _, dh = net.output(h, target, kind, grads, learn)
    loss = lambda: -net.output(h, target, kind)[0].mean()
    for array, grad in [(h, dh), (net.p["C"], grads["C"]), (net.p["W"], grads["W"]), (net.p["w"], grads["w"]), (net.p["c"], grads["c"])]:
        for at in [0, array.size // 2, array.size - 1]:
            old = array.flat[at]
            array.flat[at] = old + 1e-5
            up = loss()
            array.flat[at] = old - 1e-5
            down = loss()
            array.flat[at] = old
            assert grad.flat[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_gradient_through_time(small, monkeypatch):
    v, net, docs = small
    monkeypatch.setattr(L, "RATE", 0.0)
    monkeypatch.setattr(L, "WINDOW", 200)
    monkeypatch.setattr(L, "STREAMS", 100)
    squares = {k: np.zeros_like(v, dtype=float) for k, v in net.squares().items()}
    net.train(docs, squares)  # one window, so the squares are those of the whole gradient
    tokens = sum(len(n) for n, _ in docs)
    loss = lambda: -net.score(docs).sum() / tokens
    for name in ("U", "E"):
        p = net.p[name]
        for at in [0, 5, L.HIDDEN, 2 * L.HIDDEN + 3, p.size - 1]:
            old = p.flat[at]
            p.flat[at] = old + 3e-3
            up = loss()
            p.flat[at] = old - 3e-3
            down = loss()
            p.flat[at] = old
            assert squares[name].flat[at] ** 0.5 == pytest.approx(abs(up - down) / 6e-3, rel=0.02, abs=1e-5)


def test_query_against_counting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "HEAD", 20)
    monkeypatch.setattr(L, "TAU", 2e-3)
    rng = random.Random(7)
    words = [f"w{k}" for k in range(300)] + ["Été", "ÀB", "ab"]
    rows = [(k, " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randrange(0, 80))), "w", 1, 2) for k in range(120)]
    rows += [(500, None, "w", 1, 2), (501, " \n", "w", 1, 2), (None, "null id", "w", 1, 2), rows[4], (502, "W1 " * 5000 + "unseen", "w", 1, 2)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in L.op7_gru_lm(spark, str(tmp_path)).collect()), key=str)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    toks = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(w for d, t, *_ in rows if not held(d) for w in toks(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((d, held(d), len(toks(t)), sum(c[w] > 0 for w in toks(t)), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks(t))) for d, t, *_ in rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(g[6] < 0 and math.isfinite(g[6]) for g in got)


def test_learned_model_beats_the_base_on_held_out_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "SHARES", 2)
    rng = random.Random(9)
    nxt = {f"v{k}": [f"v{(3 * k + j) % 40}" for j in range(3)] for k in range(40)}
    rows = []
    for k in range(400):
        w = ["v0"]
        while len(w) < 80:
            w.append(rng.choice(nxt[w[-1]]))
        rows.append((k, " ".join(w), "w", 1, 2))
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = L.op7_gru_lm(spark, str(tmp_path)).where("held_out").toPandas()
    assert (got["score"] - got["base_score"]).sum() / got["n_tokens"].sum() > 0.2


def test_nothing_to_train_on(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert L.op7_gru_lm(spark, str(tmp_path / "none")).collect() == []
    d = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    spark.createDataFrame([(d, "a b", "w", 1, 2)], SCHEMA).write.parquet(str(tmp_path / "one/documents.parquet"))
    r = L.op7_gru_lm(spark, str(tmp_path / "one")).collect()[0]
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0)
    assert math.isfinite(r["score"])


def test_every_training_document_is_learned_from(spark, monkeypatch):
    texts = [(k if k else None, f"word{k} a b".encode()) for k in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text binary").select(
        "text", L.F.pmod(L.F.xxhash64("doc_id"), L.F.lit(L.SHARES)).cast("int").alias("share"))
    v = vocabulary([t for _, t in texts], L.HEAD)
    seen = []
    monkeypatch.setattr(L, "average", lambda trained, size, levels: seen.append(
        sum(r["weight"] for r in trained.where("piece = -1").collect())))
    L.train_network(df, v)
    assert sum(seen) == v.train_tokens


def test_all_broadcast_words_have_outputs_and_vectors_of_their_own():
    texts = [b" ".join(b"w%d" % k for k in range(3000) for _ in range(1 + 300 // (k + 1)))]
    v = vocabulary(texts, L.HEAD)
    net = L.Network(v)
    assert v.head == 3001 and 20 < v.head_classes <= 55
    assert len(set(net.inputs_of(np.arange(3001), v.classes).tolist())) == 3001
    gen = np.random.default_rng(3)
    for k, p in net.p.items():
        net.p[k] = p + gen.normal(0, 0.3, p.shape)
    h = gen.normal(0, 1, (2, L.HIDDEN))
    many = np.repeat(h[:1], 3001, axis=0)
    p = np.exp(net.output(many, np.arange(3001), v.classes)[0])
    tail = sum(math.exp(net.output(h[:1], np.array([-1]), np.array([v.head_classes + k]))[0][0]) for k in range(L.TAIL_CLASSES))
    assert p.sum() + tail == pytest.approx(1)
    inside = [i for i in range(1025, 3001) if v.classes[i] == v.classes[2000]]
    a, b = (net.output(np.repeat(x, len(inside), axis=0), np.array(inside), v.classes[inside])[0] for x in (h[:1], h[1:]))
    assert np.ptp(a - b) > 0.1  # the state tells words of one class apart
    lone = vocabulary([b"a"], L.HEAD)
    assert lone.head == 2 and np.isfinite(L.Network(lone).score([lone.read(b"a")[:2]])).all()


@pytest.mark.parametrize("levels", [1, 2])
def test_changes_are_averaged_by_pieces(spark, monkeypatch, levels):
    monkeypatch.setattr(L, "PIECE", 3)
    flats = [(0, 1e6, np.arange(8) / 8), (1, 3e6, np.arange(8) / 8 * 5), (0, 5e5, np.array([0, 0, 0, 1, 0, 0, 0, 0.0]))]
    rows = [tuple(c[0].as_py() for c in b.columns) for f in flats for b in L.pieces(*f)]
    got = L.average(spark.createDataFrame([(a, b, c, bytearray(d)) for a, b, c, d in rows], L.TRAINED), 8, levels)
    assert len(rows) == 4 + 4 + 2  # a piece without a change is not sent
    want = (np.arange(8) * 2 + np.array([0, 0, 0, 0.5, 0, 0, 0, 0])) / 4.5
    assert got == pytest.approx(want, rel=2e-3)
    assert L.average(spark.createDataFrame([], L.TRAINED), 8, levels) is None


def test_scores_of_the_query_step_by_step(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "TAU", 5e-3)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(150)] + ["ß", "Éa"]
    rows = [(k, " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randrange(0, 300))), "w", 1, 2) for k in range(60)]
    rows += [(None, None, "w", 1, 2), (70, "w0 W1 " * 700 + "unseen", "w", 1, 2)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    kept = {}

    def learned(texts, vocab):
        net = L.Network(vocab)
        kept["flat"] = net.flat() + np.random.default_rng(2).normal(0, 0.2, len(net.flat())).astype(np.float32)
        kept["vocab"] = vocab
        return kept["flat"]

    monkeypatch.setattr(L, "train_network", learned)
    got = {r["doc_id"]: r["score"] for r in L.op7_gru_lm(spark, str(tmp_path)).collect()}
    vocab = kept["vocab"]
    vocab.prepare()
    net = L.Network(vocab, kept["flat"])
    counts = Counter(w for d, t, *_ in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for w in (t or "").encode().lower().split())
    for d, t, *_ in rows:
        numbers, classes, rare = vocab.read((t or "").encode())
        want = plain_score(net, numbers, classes) / math.log(10)
        for n, k in zip(numbers, classes):
            if n < 0:
                want += math.log10((counts[rare.pop(0)] + 1) / vocab.tail_mass[k - vocab.head_classes])
        assert got[d] == pytest.approx(want, rel=1e-4), d


def test_a_token_meets_few_outputs():
    v = vocabulary([b" ".join(b"w%d" % k for k in range(5000) for _ in range(1 + 3000 // (k + 1)))], L.HEAD)
    words = np.array([r.stop - r.start for r in v.words_of])[v.part]
    parts = np.array([r.stop - r.start for r in v.parts_of])[v.head_class]
    mass = (v.counts[:v.head] + 1) / (v.counts[:v.head] + 1).sum()
    two_levels = 2 * np.sqrt(mass).sum()
    assert ((words + parts) * mass).sum() + v.head_classes < 0.8 * two_levels
    assert sum(r.stop - r.start for r in v.words_of) == v.head


def test_gradient_of_the_parts():
    v = vocabulary([b" ".join(b"w%d" % k for k in range(300) for _ in range(1 + 300 // (k + 1)))], L.HEAD)
    net, gen = L.Network(v), np.random.default_rng(3)
    assert max(r.stop - r.start for r in v.parts_of) > 1
    net.p = {k: p + gen.normal(0, 0.3, p.shape) for k, p in net.p.items()}
    target = np.arange(0, v.head, 3)
    h = gen.normal(0, 1, (len(target), L.HIDDEN))
    grads = {k: np.zeros_like(p) for k, p in net.p.items()}
    net.output(h, target, v.classes[target], grads, lambda *_: None)
    for name in "Ss":
        array, grad = net.p[name], grads[name]
        for at in range(0, array.size, max(1, array.size // 7)):
            old, loss = array.flat[at], []
            for shift in (1e-5, -1e-5):
                array.flat[at] = old + shift
                loss.append(-net.output(h, target, v.classes[target])[0].mean())
            array.flat[at] = old
            assert grad.flat[at] == pytest.approx((loss[0] - loss[1]) / 2e-5, abs=1e-6)


def test_logits_beyond_the_range_of_exponentials(small):
    v, net, _ = small
    h = np.ones((v.head, L.HIDDEN))
    net.p["W"][3], net.p["w"][4], net.p["c"][0] = 30.0, -900.0, 800.0
    got = net.output(h, np.arange(v.head), v.classes[:v.head])[0]
    assert np.isfinite(got).all() and (got <= 1e-9).all()


def test_long_documents_are_learned_from_in_pieces_side_by_side(small, monkeypatch):
    v, net, _ = small
    monkeypatch.setattr(L, "LEARNED", 64)
    monkeypatch.setattr(L, "RATE", 0.0)
    numbers = np.random.default_rng(4).integers(1, v.head, 1000).astype(np.int32)
    doc, steps, learned = (numbers, v.classes[numbers]), [], []
    gates, output = L.Network.gates, L.Network.output
    monkeypatch.setattr(L.Network, "gates", lambda self, e, h, *out: steps.append(h.shape[1]) or gates(self, e, h, *out))
    monkeypatch.setattr(L.Network, "output", lambda self, h, y, *a: learned.append((h.copy(), y.copy())) or output(self, h, y, *a))
    net.train([doc], net.squares())
    assert len(steps) == L.RUN_IN + 64  # not one step a token
    assert sorted(np.concatenate([y for _, y in learned]).tolist()) == sorted(numbers.tolist())
    fed, h = net.feed(*doc), np.zeros((1, L.HIDDEN))
    for x in fed[64 - L.RUN_IN:65]:  # the second piece starts after the tokens before it
        h = net.step(np.array([x]), h)[0]
    assert np.abs(learned[0][0] - h).max(axis=1).min() < 1e-5
