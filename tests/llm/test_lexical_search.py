import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from velolake.llm import lexical_search as S

SCHEMA = "doc_id long, text string, rank int, number int, item_id string, score int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, limit):
    held = [Counter(terms(t)) for _, t in docs]
    n, length = sum(bool(h) for h in held), sum(sum(h.values()) for h in held)
    df = Counter(t for h in held for t in h)
    out = []
    for item, text in items:
        found = []
        for (i, _), h in zip(docs, held):
            m = 100 - 50 + 50 * sum(h.values()) * n // length if n else 1
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * h[t] // (1000 * h[t] + 20 * m))
                        for t in set(terms(text)))
            if score > 0:
                found.append((-score, S.LAST_ID if i is None else i, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda r: r[:2])[:limit], 1)]
    return sorted(out, key=str)


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "the", "The", "of"]
    odds = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, odds, k=rng.randint(1, 80)))) for i in range(n)]
    docs += [(n + 1, None), (n + 2, ""), (n + 3, "?? !!"), (n + 4, "w1, w2-W3 " * 30000), (None, "w50 w51 w52")]
    docs += [(n + 10 + i, "w3 w40 straße the copy") for i in range(200)]
    items = [(k, " ".join(rng.sample(words, 7))) for k in range(12)]
    return docs, items + [(50, None), (51, "..."), (52, "absent words"), (53, "copy"), (None, "w50 the"), (0, "w50 w50 THE")]


def run(spark, docs, items, limit, parts=5):
    df = spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in docs], SCHEMA).repartition(parts)
    out = S.search(df, spark.createDataFrame(items, "item_id long, text string"), limit)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("limit", [1, 50, 1000])
def test_lists_equal_brute_force(spark, limit):
    docs, items = corpus()
    assert run(spark, docs, items, limit) == brute(docs, items, limit)


def test_blocks_of_items_and_small_tries_change_nothing(spark, monkeypatch):
    docs, items = corpus(150)
    monkeypatch.setattr(S, "BLOCK_TERMS", 9)
    blocks = list(S.item_blocks(spark.createDataFrame(items, "item_id long, text string")))
    assert len(blocks) > 5 and max(len({t for _, _, x in b for t in x}) for b in blocks) <= 9
    assert run(spark, docs, items, 20) == brute(docs, items, 20)


def test_repeated_rows_and_empty_tables(spark):
    docs = [(1, "a b"), (1, "a b"), (2, "b"), (3, "b c")] * 3
    assert [r[1] for r in run(spark, docs, [(9, "c")], 50)] == [1, 2, 3]
    assert run(spark, [], [(9, "c")], 50) == [] and run(spark, docs, [], 50) == []
    twice = run(spark, docs, [(9, "c"), (9, "c")], 50)
    assert [r[1] for r in twice] == [1, 1, 2, 2, 3, 3]


def trie(rows, width, leaf, monkeypatch):
    monkeypatch.setattr(S, "LEAF", leaf)
    vectors = [(np.array(sorted(r)), np.array([r[t] for t in sorted(r)])) for r in rows]
    return S.Trie(np.arange(len(rows)), np.array([60 + len(r) for r in rows]), vectors, width)


def test_trie_shares_paths_and_bounds_hold(monkeypatch):
    rng = random.Random(2)
    rows = [{t: rng.randint(1, 4) for t in range(9) if rng.random() < 0.5} or {0: 1} for _ in range(300)]
    tree = trie(rows, 9, 3, monkeypatch)
    asked, weights = np.array([1, 4, 8]), np.array([5, 70, 900])
    exact = S.scores(tree.tf[:, asked], tree.norms, weights)
    bounds = S.scores(tree.most[:, asked], tree.least, weights)
    seen = []
    for k, (lo, hi) in enumerate(zip(tree.lo, tree.hi)):
        assert bounds[k] >= exact[lo:hi].max() and tree.first[k] == tree.ids[lo:hi].min()
        below = tree.children[k]
        if below:
            assert [tree.lo[c] for c in below] + [hi] == [lo] + [tree.hi[c] for c in below]
        else:
            seen += range(lo, hi)
            paths = {tuple(np.flatnonzero(x)) for x in tree.tf[lo:hi]}
            assert hi - lo <= 3 or len(paths) == 1
    assert sorted(seen) == list(range(300))


def test_search_leaves_out_subtrees(monkeypatch):
    rng = random.Random(4)
    rows = [{t: 1 for t in rng.sample(range(200), 8)} for _ in range(3000)]
    tree = trie(rows, 200, 8, monkeypatch)
    scored = []
    plain = S.scores
    monkeypatch.setattr(S, "scores", lambda tf, m, w: scored.append(len(tf)) or plain(tf, m, w))
    best, asked = S.Best(5), np.array([0, 1])
    S.descend(tree, asked, np.array([900, 800]), best)
    exact = plain(tree.tf[:, asked], tree.norms, np.array([900, 800]))
    order = np.lexsort((tree.ids, -exact))[:5]
    assert best.score.tolist() == exact[order].tolist() and best.ids.tolist() == tree.ids[order].tolist()
    assert sum(scored) < 2000
