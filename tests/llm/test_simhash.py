import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from velolake.llm import simhash as S
from velolake.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, fp string, row int"


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids = [d for d, _ in prints]
    comp = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a, x in prints:
            for b, y in prints:
                if (x ^ y).bit_count() <= 2 and comp[b] < comp[a]:
                    comp[a] = comp[b]
                    changed = True
    return comp


def texts(rng):
    words = [f"w{i}" for i in range(50)] + ["É", "Ünï"]
    out = [None, "", "  \n", "One", "one", "a b", "x" * 5000]
    for _ in range(30):
        out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))))
    for _ in range(30):
        w = rng.choice(out[7:]).split()
        w[rng.randrange(len(w))] = rng.choice(words)
        out.append("\t".join(w))
    return out


def test_fingerprint_of_long_text_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choice("ab cd ef gh".split()) for _ in range(3000))
    whole = S.simhash(text.encode())
    real = S.word_blocks
    monkeypatch.setattr(S, "word_blocks", lambda data: real(data, 100))
    assert S.simhash(text.encode()) == whole == brute_print(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 4])
def test_trie_pairs_against_all_pairs(bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = rng.integers(0, 64, (40, 8), dtype=np.uint64)
    near = np.concatenate([base] + [base ^ (np.uint64(1) << flips[:, k]) for k in range(8)])
    near = np.concatenate([near, near ^ (np.uint64(1) << np.uint64(3))])
    values = np.unique(near)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
            if int(values[i] ^ values[j]).bit_count() <= bits}
    got = {(min(a, b), max(a, b)) for i, j in S.trie_pairs(values, S.node_pairs(values, 0, -1, 8), bits)
           for a, b in zip(i.tolist(), j.tolist())}
    assert got == want


@pytest.mark.parametrize("hot", [1 << 15, 3])
def test_components_of_prints(spark, hot):
    rng = np.random.default_rng(5)
    base = np.concatenate([rng.integers(0, 1 << 63, 10, dtype=np.uint64),
                           np.uint64(1 << 50) + np.arange(60, dtype=np.uint64)])
    near = np.unique(np.concatenate([base, base ^ np.uint64(1 << 40), base ^ np.uint64(1 << 63)]))
    prints = [(i, int(v)) for i, v in enumerate(near)]
    df = spark.createDataFrame([(i, int(np.uint64(v).view(np.int64))) for i, v in prints], "first long, fp long")
    edges = S.fingerprint_links(df.select("fp"), 2, hot=hot)
    roots = connected_components(edges, "t").join(df, F.col("node") == F.col("fp"))
    low = {r["root"]: r["low"] for r in roots.groupBy("root").agg(F.min("first").alias("low")).collect()}
    got = {i: i for i, _ in prints} | {r["first"]: low[r["root"]] for r in roots.collect()}
    assert got == brute_components(prints)


def test_query_against_brute_force(spark, tmp_path):
    rows = [(i * 3, t, "en", "clash", 1) for i, t in enumerate(texts(random.Random(3)))]
    rows += [rows[8], rows[9]]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in S.op6_simhash(spark, str(tmp_path)).collect())
    prints = [(r[0], brute_print(r[1])) for r in rows]
    comp = brute_components(prints)
    assert got == sorted((d, f"{p:016x}", comp[d]) for d, p in prints)
    kept = S.keep_first(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "fp", "row"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(comp.values()))


def test_empty_and_null_ids(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert S.op6_simhash(spark, str(tmp_path)).collect() == []
    rows = [(None, "a b c d", None, None, None), (None, "a b c d", None, None, None),
            (4, "A B C D", None, None, None), (None, "q r s", None, None, None)]
    kept = S.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("4", "A B C D"), ("None", "q r s")]


def test_star_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (100, 102), (100, 103)]
    random.Random(2).shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102, 103)}


def test_of_repeated_rows_the_least_stays(spark):
    rows = [(1, "one two three four", lang, n) for lang, n in (("fr", 1), ("de", 7), ("de", 3), (None, 9))] + [(2, "something else entirely here", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int")
    for parts in (1, 3, 7):
        got = sorted(map(tuple, S.keep_first(df.repartition(parts, "n")).collect()))
        assert got == [(1, "one two three four", "de", 3), (2, "something else entirely here", "en", 1)]
    plain = df.select("doc_id", "text")
    assert sorted(map(tuple, S.keep_first(plain).collect())) == [(1, "one two three four"), (2, "something else entirely here")]
