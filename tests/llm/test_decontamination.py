import random

import pytest

from velolake.llm import decontamination as D

DOCS = "doc_id long, text string, found string, item_id int"


def distances(pattern, window):
    """Last row of the plain matrix: least edits of the pattern to a substring ending there."""
    col = list(range(len(pattern) + 1))
    out = [col[-1]]
    for ch in window:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(col[i] + (p != ch), col[i + 1] + 1, new[i] + 1))
        col = new
        out.append(col[-1])
    return out


def edited(text, n, rng):
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else rng.choice("abcxyz")) + text[at + (kind != 2):]
    return text


@pytest.mark.parametrize("seed", range(6))
def test_bit_vectors_against_the_matrix(seed):
    rng = random.Random(seed)
    for _ in range(60):
        p = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 90)))
        w = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 120)))
        want = distances(p, w)
        best, end = D.best_distance(p, D.masks(p), w)
        assert best == min(want) and want[end] == best


def make(rng):
    items = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(40, 120))) for _ in range(12)]
    docs = [None, "", "  "]
    for k in range(60):
        filler = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 200))) for _ in range(2)]
        item = rng.choice(items)
        docs.append(filler[0] + edited(item, rng.randrange(0, 8), rng) + filler[1])
        if k % 9 == 0:
            docs.append(filler[0] + item.upper().replace(" ", " \n ") + filler[1])
    docs.append("zz " * 40000 + items[3] + " zz" * 40000)
    return items, docs


@pytest.mark.parametrize("block", [8_000_000, 150])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, block):
    items, docs = make(random.Random(8))
    bench = [(i * 2, t) for i, t in enumerate(items)] + [(90, items[0]), (91, None), (92, " \n"), (93, "q")]
    rows = [(i, t, "x", 1) for i, t in enumerate(docs)] + [(None, items[5], "x", 1), (3, docs[3], "x", 1)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    monkeypatch.setattr(D, "leaks", lambda d, b, r=0.05, c=block, f=D.leaks: f(d, b, r, c))
    got = sorted(map(tuple, D.op9_decontamination(spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        text = D.normalise(text)
        for item_id, item in bench:
            item = D.normalise(item)
            if item:
                d = 0 if item in text else min(distances(item, text)) if len(text) < 2000 else 99
                if d <= int(len(item) * 0.05):
                    want.append((doc_id, item_id, d))
    assert [x[:2] for x in got] == [x[:2] for x in sorted(want, key=str)]
    assert all(g[2] == w[2] for g, w in zip(got, sorted(want, key=str)))
    kept = D.keep_clean(spark.createDataFrame(rows, DOCS), spark.createDataFrame(bench, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "found", "item_id"]
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(
        str(r[0]) for r in rows if r[0] not in {w[0] for w in want})


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some text", None, None)], DOCS)
    assert D.leaks(docs, empty).collect()[0]["found"] == []
    assert D.leaks(spark.createDataFrame([], DOCS), empty).collect() == []
    assert D.leaks(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "abc")], "item_id long, text string")).collect() == []


def test_many_blocks_of_items_are_not_chained_in_a_task(spark):
    items, docs = make(random.Random(3))
    bench = spark.createDataFrame([(i, f"{t} {i:04d}") for i, t in enumerate(items * 5)], "item_id long, text string")
    rows = [(i, t, "x", 1) for i, t in enumerate(docs)] + [(7, f"{items[2]} 0002 and {items[5]} 0017", "y", 2), (None, docs[5], "x", 1)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert len(list(D.item_blocks(bench, 10))) == 60
    many, one = D.leaks(df, bench, 0.05, 10), D.leaks(df, bench)
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 0  # written by the blocks' jobs
    key = lambda r: str(tuple(r))
    got, want = (sorted(((r["row"], sorted(map(tuple, r["found"]))) for r in x.collect()), key=key) for x in (many, one))
    assert got == want and any(f for _, f in got)
