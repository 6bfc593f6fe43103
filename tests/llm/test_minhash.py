import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from velolake.llm import minhash as M

SCHEMA = "doc_id long, text string, _w string, fp string, g int, key int"


def h(word):
    x = xxhash.xxh64_intdigest(word, 42)
    return x - (1 << 64) if x >> 63 else x


def hl(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def shingles(text):
    words = (text or "").lower().encode().split()
    w = [h(x) for x in words]
    if not w:
        return set()
    return {hl(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {hl(w)}


def brute_print(text):
    bins = {}
    for x in shingles(text):
        b = x >> 56
        bins[b] = min(bins.get(b, x), x)
    order = list(range(-128, 128))
    if not bins:
        return "f" * 256
    out = []
    for i, b in enumerate(order):
        if b in bins:
            out.append(bins[b])
            continue
        near = [M._mix(i * M.PROBES + j) % 256 for j in range(M.PROBES)]
        hit = [p for p in near if order[p] in bins]
        if not hit:
            rank = lambda p: xxhash.xxh64_intdigest(struct.pack("<i", p), xxhash.xxh64_intdigest(struct.pack("<i", i), 42))
            sign = lambda x: x - (1 << 64) if x >> 63 else x
            hit = sorted((p for p in range(256) if order[p] in bins), key=lambda p: sign(rank(p)))
        out.append(bins[order[hit[0]]])
    return "".join(f"{v & 15:x}" for v in out)


def near(a, b):
    if a == b:
        return 1.0
    if "f" * 256 in (a, b):
        return 0.0
    p = sum(x == y for x, y in zip(a, b)) / 256
    return min(1.0, max(0.0, (p - 1 / 16) / (1 - 1 / 16)))


def make(rng):
    texts = [None, "", " \t\n", "one", "a b c d", "É  Ü ñ", "x" * 3000]
    for _ in range(25):
        texts.append(" ".join(rng.choice("alpha beta gamma delta ñu eps zeta".split()) + str(rng.randrange(40))
                              for _ in range(rng.randrange(1, 400))))
    return texts + [texts[10], texts[10]]


@pytest.mark.parametrize("per_bucket", [2000, 3])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, per_bucket):
    rows = [(7 * i - 50, t) for i, t in enumerate(make(random.Random(1)))] + [(None, "null one"), (20, "same id b"), (20, "same id a"), (20, "same id a")]
    df = spark.createDataFrame([(d, t, "w", "f", 1, 2) for d, t in rows], SCHEMA)
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(M, "with_next", lambda *a, f=M.with_next: f(*a, per_bucket))
    got = sorted((tuple(r) for r in M.op2_fingerprint(spark, str(tmp_path)).collect()), key=str)
    ordered = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], (r[1] or "").encode()))
    want = []
    for k, (d, t) in enumerate(ordered):
        t, nxt = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, e, n = brute_print(t), brute_print(edited), brute_print(nxt)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, e, near(a, e), near(a, n)))
    want.sort(key=str)
    assert [w[:5] for w in got] == [w[:5] for w in want]
    assert all(g[5:] == pytest.approx(w[5:]) for g, w in zip(got, want))


def test_likeness_estimates_jaccard(spark):
    rng = random.Random(9)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([30, 200, 1500]))]
        other = words[:int(len(words) * rng.random())]
        other += [f"v{rng.randrange(10 ** 6)}" for _ in range(len(words) - len(other))]
        rows.append((" ".join(words), " ".join(other)))
    df = M.with_fingerprint(M.with_fingerprint(spark.createDataFrame(rows, "a string, b string"), "a", "fa"), "b", "fb")
    errors = []
    for r in df.select("a", "b", M.likeness(F.col("fa"), F.col("fb")).alias("j")).collect():
        x, y = shingles(r["a"]), shingles(r["b"])
        errors.append(r["j"] - len(x & y) / len(x | y))
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.2


def test_single_and_empty(spark, tmp_path):
    spark.createDataFrame([(4, "a b c d e f", *[None] * 4)], SCHEMA).write.parquet(str(tmp_path / "one/documents.parquet"))
    r = M.op2_fingerprint(spark, str(tmp_path / "one")).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert M.op2_fingerprint(spark, str(tmp_path / "none")).collect() == []
