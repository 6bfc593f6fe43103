import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from velolake.llm import quality as Q

SCHEMA = "doc_id long, text string, score int, row string, quality string"


def plain_logit(p, text):
    """The network as its definition says, window by window."""
    codes = list(text)
    size = -(-(len(codes) + Q.WIDTH - 1) // Q.HALF) * Q.HALF
    codes += [Q.PAD] * (size - len(codes))
    half = []
    for lo in range(0, size, Q.HALF):
        wins = [np.concatenate([p["E"][c] for c in codes[i:i + Q.WIDTH]]) @ p["W"]
                for i in range(lo, lo + Q.HALF) if i + Q.WIDTH <= size]
        half.append(np.max(wins, axis=0))
    chunks = [np.maximum(a, b) for a, b in zip(half, half[1:])] or half
    judged = np.array([np.maximum(np.maximum(c + p["b"], 0) @ p["H"] + p["c"], 0) for c in chunks])
    return np.concatenate([judged.mean(axis=0), judged.max(axis=0)]) @ p["v"] + p["o"][0]


def params(seed=1):
    rng = np.random.default_rng(seed)
    return {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in Q.initial().items()}


def texts(seed=0):
    rng = random.Random(seed)
    return [bytes(rng.choices(b"abc \xc3\xa4#", k=n)) for n in (0, 1, 7, 121, 122, 128, 129, 600, 1500, 3)]


def test_logits_equal_the_definition():
    p = params()
    assert Q.Network(p).logits(texts()) == pytest.approx([plain_logit(p, t) for t in texts()], abs=1e-4)


def test_segments_of_a_long_text_change_nothing(monkeypatch):
    p = params()
    want = Q.Network(p).logits(texts())
    for segment in (128, 256, 512):
        monkeypatch.setattr(Q, "SEGMENT", segment)
        assert Q.Network(p).logits(texts()) == pytest.approx(want, abs=1e-5)


def test_gradients_equal_differences():
    p = {k: v.astype(np.float64) for k, v in params(3).items()}
    net, some, label = Q.Network(p), texts(4), np.arange(10) % 2.0

    def loss():
        z = np.array([plain_logit(p, t) for t in some])
        return np.mean(np.logaddexp(0, z) - label * z)

    grads = net.gradients(some, label)
    for k, at in (("E", (97, 2)), ("E", (Q.PAD, 0)), ("W", (5, 3)), ("W", (40, 20)), ("b", (4,)), ("H", (3, 5)), ("c", (2,)), ("v", (20,)), ("o", (0,))):
        old, e = p[k][at], 1e-5
        p[k][at] = old + e
        up = loss()
        p[k][at] = old - e
        down = loss()
        p[k][at] = old
        assert grads[k][at] == pytest.approx((up - down) / 2 / e, rel=0.02, abs=2e-5)


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    syllables = ["an", "the", "ou", "re", "ti", "on", "är", "he", "st"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        good = i % 3 > 0
        docs.append((i, " ".join(words) if good else " ".join(w + rng.choice(["###", "$$$", "!!"]) for w in words)))
        labels.append((i, int(good)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(i, t, 1, "r", "q") for i, t in docs], SCHEMA),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus()
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    odd = [(1000, None), (1001, ""), (1002, "a"), (None, "word " * 20), (5, docs[5][1]), (5, docs[5][1]),
           (1003, "the an ou re " * 60000), (1004, "x### " * 60000)]
    df, known = frames(spark, docs + odd, [x for x in labels if x[0] not in held] + [(None, 0), (1000, None), (4000, 1)])
    p = Q.train(df, known)
    got = [(r["row"]["doc_id"], r["row"]["text"], r["score"]) for r in Q.score_quality(df, p).collect()]
    assert len(got) == len(docs) + len(odd) and all(0 <= s <= 1 for _, _, s in got)
    score = {i: s for i, _, s in got}
    right = [(score[i] >= Q.THRESHOLD) == bool(q) for i, q in labels if i in held]
    assert np.mean(right) > 0.95
    assert score[1000] == score[1001] and len({s for i, _, s in got if i == 5}) == 1
    assert score[1003] > score[1004]


def test_nothing_or_one_label_to_learn_from(spark):
    docs, labels = corpus(30)
    df, _ = frames(spark, docs, labels)
    for known, want in (([], 0.5), ([(i, 1) for i in range(9)], 10 / 11)):
        p = Q.train(df, spark.createDataFrame(known, "doc_id long, quality int"))
        assert [r["score"] for r in Q.score_quality(df, p).collect()] == pytest.approx([want] * 30)
    assert Q.score_quality(df.limit(0), Q.initial()).collect() == []


def test_the_sample_is_bounded_by_rows_and_length(spark):
    docs, labels = corpus(60)
    df, known = frames(spark, docs + [(0, "hot " * 10)] * 300 + [(1, "y" * 5000)], labels)
    rows = Q.sampled(df, known, sample=10, longest=4000).collect()
    assert len(rows) == 20 and max(len(r["text"]) for r in rows) <= 4000
    assert Q.sampled(df, known, sample=100, longest=4000).where("quality = 0").count() > 20


def test_query_holds_out_by_id(spark):
    out = Q.op11_quality(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and dict(out.dtypes)["predicted"] == "int"
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert out.where(F.col("score").isNull()).count() == 0
