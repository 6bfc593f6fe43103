import hashlib
import random

import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from velolake.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, key string, h1 int, bucket int"


class Lists(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, a, b):
        return a + b


LISTS = Lists()


def brute(rows, length=50):
    low = {}
    for d, text in rows:
        raw, d = (text or "").encode(), S.LOWEST if d is None else d
        for p in range(len(raw) - length + 1):
            g = raw[p:p + length]
            low[g] = min(low.get(g, d), d)
    out = []
    for d, text in rows:
        raw, key = (text or "").encode(), S.LOWEST if d is None else d
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if low[raw[p:p + length]] < key:
                gone[p:p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def make(rng):
    word = lambda: "".join(rng.choice(["th", "er", "é", "on", "中", "in "]) for _ in range(rng.randrange(1, 5)))
    passages = [" ".join(word() for _ in range(rng.randrange(8, 60))) for _ in range(12)]
    texts = [None, "", "a" * 49, "a" * 50, "a" * 120, "b" + "a" * 60, "x" * 3000]
    for _ in range(70):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randrange(1, 40)))
                 for _ in range(rng.randrange(1, 6))]
        text = " ".join(parts)
        if rng.random() < 0.4:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("qz") + text[at + 1:]
        texts.append(text)
    texts += [texts[10], texts[10], texts[11], texts[10] + " tail", passages[0][3:], passages[1][:-2]]
    return texts


@pytest.mark.parametrize("limit", [0xFFFFFF, 0xFF])
def test_each_string_is_in_one_run(monkeypatch, limit):
    monkeypatch.setattr(S, "_POS", np.uint64(limit))
    texts = [(t or "").encode() for t in make(random.Random(1))]
    number, start, count, hashes = S.minimizers(texts, 50, 20)
    seen = [(k, p) for k, a, n in zip(number, start, count) for p in range(a, a + n)]
    want = [(k, p) for k, t in enumerate(texts) for p in range(len(t) - 49)]
    assert sorted(seen) == want
    by = {}
    for k, a, n, h in zip(number, start, count, hashes):
        for p in range(a, a + n):
            by.setdefault(texts[k][p:p + 50], set()).add(h)
    assert all(len(x) == 1 for x in by.values())


def test_sorting_orders_suffixes():
    rng = random.Random(3)
    data = bytes(rng.choice(b"ab") for _ in range(3000)) + b"a" * 300 + bytes(range(256)) * 2
    places = np.array(rng.sample(range(len(data) - 50), 2500))
    for shallow in (1, 3, 7):
        order, new = S.sort_suffixes(data, places, 50, shallow)
        got = [data[p:p + 50] for p in places[order].tolist()]
        assert got == sorted(got) and sorted(order.tolist()) == list(range(len(places)))
        assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


def test_blind_trie():
    rng = random.Random(5)
    strings = list({bytes(rng.choice(b"xyz") for _ in range(12)) for _ in range(800)})
    assert [strings[k] for k in S.blind_trie_order(strings)] == sorted(strings)
    assert S.blind_trie_order([b"a"]) == [0]


@pytest.mark.parametrize("chunk", [1 << 23, 700])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, chunk):
    texts = make(random.Random(chunk))
    rows = [((i * 37) % 101, t) for i, t in enumerate(texts)]
    rows += [(None, texts[20]), (rows[21][0], texts[22]), rows[15], rows[15], (200, texts[20] + texts[21])]
    spark.createDataFrame([(d, t, "k", 1, 2) for d, t in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(S, "CHUNK", chunk)
    got = sorted(map(tuple, S.op8_suffix_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert S.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("split", [1 << 18, 40])
def test_a_hot_minimizer_is_split(spark, tmp_path, monkeypatch, split):
    rng = random.Random(split)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    stem = " " * 20
    shared = [letters(30) + stem + letters(30) for _ in range(4)]
    texts = [letters(40) + stem + letters(40) + stem + rng.choice(shared) for _ in range(60)] + make(rng)
    rows = [((i * 37) % 211, t) for i, t in enumerate(texts)] + [(None, texts[3])]
    spark.createDataFrame([(d, t, "k", 1, 2) for d, t in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(S, "SPLIT", split)
    for hot, group, chunk in ((5, 1 << 15, 1 << 23), (0, 3, 700)):
        monkeypatch.setattr(S, "HOT", hot)
        monkeypatch.setattr(S, "GROUP", group)
        monkeypatch.setattr(S, "CHUNK", chunk)
        assert sorted(map(tuple, S.op8_suffix_dedup(spark, str(tmp_path)).collect()), key=str) == brute(rows)


def test_no_group_grows_with_a_hot_minimizer(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(S, "HOT", 50)
    sizes = spark.sparkContext.accumulator([], LISTS)
    monkeypatch.setattr(S, "covered", lambda contexts, *a, f=S.covered: (sizes.add([sum(len(c) - 49 for c in contexts)]), f(contexts, *a))[1])
    stem = "0123456789abcdefghij" * 2
    rows = [(k, "".join(rng.choice("klmnopqrs") for _ in range(60)) + stem + "".join(rng.choice("klmnopqrs") for _ in range(60)))
            for k in range(400)]
    S.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(sizes.value) and max(sizes.value) < sum(sizes.value) / 4


def test_marks_hold_every_hot_seed_in_bounded_space(spark, monkeypatch):
    rng = np.random.default_rng(4)
    hot, other = rng.integers(0, 1 << 63, 3000), rng.integers(0, 1 << 63, 20000)
    seeds = spark.createDataFrame([(int(x),) for x in hot], "seed long").repartition(3)
    marks = S.mark_seeds(seeds, len(hot))
    assert S.marked(marks, hot.astype(np.uint64)).all()
    assert S.marked(marks, other.astype(np.uint64)).mean() < 0.02
    monkeypatch.setattr(S, "MARKS", 1 << 10)
    marks = S.mark_seeds(seeds, len(hot))
    assert len(marks) == 16 and S.marked(marks, hot.astype(np.uint64)).all()
    assert not S.marked(S.mark_seeds(seeds.limit(0), 0), other.astype(np.uint64)).any()


def test_pairs_and_larger_groups_of_long_common_prefixes():
    rng = random.Random(9)
    stem = b"s" * 40
    parts = [stem + bytes(rng.choice(b"pq") for _ in range(10)) for _ in range(60)] + [b"t" * 24 + b"z" * 26, b"t" * 24 + b"y" * 26]
    parts += [b"u" * 50, b"u" * 50, b"u" * 49 + b"t"]
    rng.shuffle(parts)
    data, places = b"".join(parts), np.arange(len(parts)) * 50
    order, new = S.sort_suffixes(data, places, 50)
    got = [parts[i] for i in order]
    assert got == sorted(parts) and new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


def test_copies_of_a_text_do_not_make_its_strings_repeated(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(S, "CHUNK", 700)
    sizes = spark.sparkContext.accumulator([], LISTS)
    monkeypatch.setattr(S, "covered", lambda contexts, *a, f=S.covered: (sizes.add([len(contexts)]), f(contexts, *a))[1])
    texts = ["".join(rng.choice("abcdefghijkl") for _ in range(400)) for _ in range(12)]
    rows = [(100 * k + i, t) for k in range(4) for i, t in enumerate(texts)] + [(None, texts[3]), (None, texts[3]), (7, texts[7])]
    got = S.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == len(rows) and not sum(sizes.value)
    for r in got:
        low = None if r["kept"] == texts[3].encode() or r["doc_id"] is None else r["doc_id"] < 100 and r["doc_id"] != 3
        assert low is None or (r["starts"], r["ends"]) == (([], []) if low else ([0], [400]))
    assert [r["doc_id"] for r in got if r["kept"] == texts[3].encode()] == [None, None]


def test_only_strings_that_may_be_equal_are_sorted(monkeypatch):
    rng = random.Random(8)
    letters = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    stem, shared = letters(20), letters(30)
    contexts = [letters(15) + stem + letters(15 + k % 16) for k in range(300)] + [letters(k) + stem + shared for k in range(1, 16)]
    sorted_ = []
    monkeypatch.setattr(S, "sort_suffixes", lambda data, places, *a, f=S.sort_suffixes: (sorted_.append(len(places)), f(data, places, *a))[1])
    keys = np.array(rng.sample(range(1000), len(contexts)))
    record, lo, hi = S.covered(contexts, keys, np.arange(len(contexts)), 50)
    low = {}
    for c, key in zip(contexts, keys.tolist()):
        for p in range(len(c) - 49):
            low[c[p:p + 50]] = min(low.get(c[p:p + 50], key), key)
    want = {(r, p) for r, c in enumerate(contexts) for p in range(len(c) - 49) if low[c[p:p + 50]] < keys[r]}
    assert {(r, p) for r, a, b in zip(record.tolist(), lo.tolist(), hi.tolist()) for p in range(a, b - 49)} == want and want
    assert sum(sorted_) < sum(len(c) - 49 for c in contexts) / 2


def test_texts_are_told_exactly_their_repeated_seeds(spark, monkeypatch):
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdefghijkl") for _ in range(3000))
    rows = [(k, passage[40 * k:] + str(k)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.select("doc_id", *S.text_identity(docs))
    first = texts.groupBy("h1", "h2").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    seeds = S.repeated_seeds(texts, first, 50, 20, 4).collect()
    told = {r["key"]: np.frombuffer(r["seeds"], np.uint64) for r in seeds if r["key"] is not None}
    figures = [r for r in seeds if r["key"] is None]
    assert set(told) == set(range(20))
    assert sum(r["n"] for r in figures) >= len(set(np.concatenate(list(told.values())).tolist()))
    for k, text in rows:
        hashes = S.seed_id(S.minimizers([text.encode()], 50, 20)[3], 4)
        others = set(S.seed_id(S.minimizers([t.encode() for j, t in rows if j != k], 50, 20)[3], 4).tolist())
        assert set(told[k].tolist()) == set(hashes.tolist()) & others
