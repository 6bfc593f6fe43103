import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from velolake.llm import resampling as R

SCHEMA = "doc_id long, text string, score string, a int, rank int, row int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent, seed, size, longest, least):
    bucket = lambda f: zlib.crc32(f.encode()) % size
    count = lambda rows: np.bincount([bucket(f) for _, t in rows for f in features(t, longest)[1]], minlength=size).tolist()
    s, t = count(docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + size) / ((a + 1) * (sum(t) + size)))) for a, b in zip(s, t)]
    rows = []
    for k, (i, text) in enumerate(docs):
        words, feats = features(text, longest)
        weight = sum(gain[bucket(f)] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(feats), weight, score, words >= least])
    able = [r for r in rows if r[4]]
    drawn = sorted(able, key=lambda r: (-r[3], R.LAST_ID if r[0] is None else r[0]))[:percent * len(able) // 100]
    place = {id(r): n for n, r in enumerate(drawn, 1)}
    return sorted(((r[0], r[1], r[2], r[3], place.get(id(r))) for r in rows), key=str)


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gämma", "delta9", "ÄRGER", "x", "the", "of"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(n + 1, None), (n + 2, ""), (n + 3, "--- !!"), (n + 4, "the-of\x00x " * 4000), (None, "beta " * 30)]
    docs += [(n + 10 + i, "copy of the same text " * 9) for i in range(150)]
    return docs, [(0, "delta9 gämma gämma x"), (1, None), (2, "ärger the x")]


def run(spark, docs, target, **how):
    df = spark.createDataFrame([(i, t, "s", 1, 2, 3) for i, t in docs], SCHEMA).repartition(5)
    out = R.resample(df, spark.createDataFrame(target, "item_id long, text string"), **how)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_whole_result_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(R, "FINISH", 1)
    docs, target = corpus()
    for percent, size, longest, least in ((10, 10_000, 1, 20), (40, 7, 3, 1), (100, 50, 2, 0)):
        got = run(spark, docs, target, percent=percent, buckets=size, longest=longest, least_words=least)
        assert got == brute(docs, target, percent, 2024, size, longest, least)


def test_long_texts_are_read_across_blocks(monkeypatch):
    text = ("one Two, three-four " * 50).encode()
    whole = [x.tolist() for _, x in R.feature_buckets(text, R.Buckets(1000), 3)]
    monkeypatch.setattr(R, "term_blocks", lambda data: ([w] for part in R_TERMS(data) for w in part))
    parts = [x.tolist() for _, x in R.feature_buckets(text, R.Buckets(1000), 3)]
    assert len(whole) == 1 and sorted(sum(parts, [])) == sorted(whole[0])


R_TERMS = R.term_blocks


def test_empty_tables_and_nothing_drawn(spark):
    docs, target = corpus(20)
    assert run(spark, [], target) == []
    assert {r[4] for r in run(spark, docs[:5], target, percent=1)} == {None}
    assert run(spark, docs, []) == brute(docs, [], 10, 2024, 10_000, 1, 20)


def test_repeated_rows_and_a_shared_id_each_count(spark):
    docs = [(7, "same words here " * 10)] * 40 + [(None, "other words there " * 10)] * 40
    got = run(spark, docs, [(0, "words")], percent=50)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 41))
    assert len({r[3] for r in got if r[4]}) == 1 or got


def test_cutoff_is_exact_for_every_rank_and_chunk(spark):
    rng = random.Random(1)
    rows = [(rng.randint(-3, 3), rng.randint(0, 2), i) for i in range(500)] + [(0, 0, 1000 + i) for i in range(200)]
    keys = spark.createDataFrame(rows, "a long, b long, c long").repartition(6).cache()
    order = sorted(rows)
    for wanted in (1, 2, 233, 350, 699, 700, 900):
        assert R.cutoff(keys, wanted, chunk=50, finish=1) == order[min(wanted, 700) - 1]
    assert R.cutoff(keys, 0) is None
    assert R.cutoff(keys.where("a > 9"), 3) is None


def test_each_round_discards_a_quarter(spark, monkeypatch):
    rows = [(i * i % 7919, 0, i) for i in range(3000)]
    keys = spark.createDataFrame(rows, "a long, b long, c long").repartition(9).cache()
    jobs = []
    frame = type(keys)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: jobs.append(collect(self)) or jobs[-1])
    assert R.cutoff(keys, 700, chunk=100, finish=1) == sorted(rows)[699]
    sizes = [sum(r["n"] for r in got) for got in jobs if got and "n" in got[0].__fields__]
    assert all(b <= 0.75 * a + 1 for a, b in zip(sizes[1:], sizes[2:])) and len(sizes) > 5


def test_winners_are_ranked_in_parts(spark):
    docs, target = corpus(400)
    out = R.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string"), percent=80)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert out.where(F.col("rank").isNotNull()).count() == out.agg(F.max("rank")).first()[0]
