import random
import zlib

import numpy as np
import pytest

from velolake.llm import language_id as L

SCHEMA = "doc_id long, text string, lang string, row string, score int"
WORDS = {"aa": "lorem ipsum dolor sit amet", "bb": "quick brown fox jumps over", "cc": "жили были дед баба кот"}


def rows(n, rng, lo=4, hi=40):
    out = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randrange(lo, hi))), lang, "x", 1))
    return out


def test_blocks_keep_every_trigram_once():
    text = "Ab cd, éf-gh 12 ij " * 7
    codes, _ = L.trigrams(*(lambda b: (b[0], b[2]))(next(L.text_blocks([text]))))
    for size in (5, 6, 7, 16, 133, 134):
        got = [L.trigrams(j, s)[0] for j, _, s in L.text_blocks([text, None, "", "xyz"], size)]
        want = np.concatenate([codes, L.trigrams(" xyz ", [0])[0]])
        assert sorted(np.concatenate(got).tolist()) == sorted(want.tolist())


def test_filter_has_no_false_negative_and_the_stated_false_rate():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 62, 6000).astype(np.uint64)
    langs = rng.integers(0, 70, 6000)
    model = L.build_filter([f"l{k:02}" for k in range(70)], codes, langs)
    masks = model.masks(codes)
    assert all(int(masks[i, k // 64]) >> int(k % 64) & 1 for i, k in enumerate(langs))
    other = model.masks(rng.integers(0, 1 << 62, 200_000).astype(np.uint64))
    found = np.array([((other[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(70)])
    assert np.abs(found - model.false_rate()).max() < 2e-3


def test_scores_equal_set_lookup_without_false_positives():
    known = L.trigrams(" lorem ", [0])[0]
    model = L.build_filter(["aa"], known, np.zeros(len(known), np.int64))
    n, score = model.scores(["lorem lorem", "zzz", None, "", "12 34"])
    assert n.tolist() == [10, 3, 0, 0, 0]
    assert score[0, 0] == pytest.approx(1.0) and score[1, 0] < 0.01


def test_query_held_out_accuracy_and_odd_rows(spark, tmp_path):
    data = rows(400, random.Random(4))
    odd = [(1000, None, "aa", "x", 1), (1001, "", "aa", "x", 1), (1002, "12 !? \n", None, "x", 1),
           (1003, "lorem ipsum " * 30000, None, None, None), (None, "quick brown fox", "bb", "x", 1), data[3], data[3]]
    spark.createDataFrame(data + odd, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = L.op4_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(data) + len(odd)
    by = {r["doc_id"]: r for r in got}
    for doc_id, _, lang, *_ in data:
        assert by[doc_id]["lang_pred"] == lang
        assert by[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    assert [by[k]["lang_pred"] for k in (1000, 1001, 1002, 1003, None)] == ["und"] * 3 + ["aa", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = L.keep_known(spark.createDataFrame(data + odd, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "row", "score"]
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted([d[0] for d in data] + [1003, -1, 3, 3])


def test_nothing_to_learn_from(spark, tmp_path):
    df = spark.createDataFrame([(1, "lorem ipsum", None, None, None)], SCHEMA)
    got = L.predict(df, L.train(df)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert L.op4_language_id(spark, str(tmp_path)).collect() == []


def test_training_counts_are_exact(spark):
    df = spark.createDataFrame([(1, "ab ab cd", "x", None, None), (2, "ab zz", "y", None, None)], SCHEMA)
    model = L.train(df, rate=0.0, contrast=0.6)
    # "ab": 2 of 6 trigrams in x, 1 of 4 in y: 0.25 is over 0.6 * 0.33; "cd" only in x
    code = {g: L.trigrams(f" {g} ", [0])[0][0] for g in ("ab", "cd", "zz")}
    mask = {g: int(model.masks(np.array([c]))[0, 0]) for g, c in code.items()}
    assert mask == {"ab": 3, "cd": 1, "zz": 2}


def test_the_stage_learns_from_all_labelled_documents(spark):
    fifth = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 5 == 0]
    rest = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 5]
    data = [(k, "the quick brown fox jumps over lazy dogs", "en", None, None) for k in rest[:20]]
    data += [(k, "żółw gęś źdźbło ćma łąka", "pl", None, None) for k in fifth[:3]]
    kept = L.keep_known(spark.createDataFrame(data, SCHEMA))
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(k for k, *_ in data)
