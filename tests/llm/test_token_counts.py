import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from velolake.llm import token_counts as T
from velolake.llm.bpe import TOKENIZER

SCHEMA = "doc_id long, text string, file string, block int, start int"


def make(rng):
    words = ["the", "in", "é", "中", "12", "<|endoftext|>", "\n"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 50)))) for k in range(80)]
    return rows + [(None, "a null id"), (-5, None), (-6, ""), (2 ** 63 - 1, "largest"), (-2 ** 63, "x " * 9000), rows[3], rows[3]]


@pytest.mark.parametrize("block", [T.BLOCK_TOKENS, 64, 7, 1])
def test_query_against_the_tokenizer(spark, tmp_path, monkeypatch, block):
    rows = make(random.Random(block))
    if block == 1:
        rows = rows[:20]
    monkeypatch.setattr(T, "SUPER", 5)
    monkeypatch.setattr(T, "token_counts", lambda *a, f=T.token_counts: f(*a, block_tokens=block))
    spark.createDataFrame([(d, t, "f", 1, 2) for d, t in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    tok = Tokenizer.from_file(TOKENIZER)
    tok.encode_special_tokens = True
    want = sorted(((d, len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t in rows), key=str)
    assert sorted(map(tuple, T.op3_token_counts(spark, str(tmp_path)).collect()), key=str) == want


@pytest.mark.parametrize("block", [1, 3, 4, 100])
@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_files_without_headers(spark, tmp_path, block, kind):
    rng = np.random.default_rng(block)
    want = []
    for n in range(4):
        tokens = np.where(rng.random(60) < 0.3, 9, rng.integers(10, 500, 60))
        if n == 1:
            tokens[-1] = 9
        if n == 2:
            tokens[:3] = 9
        if n == 3:
            tokens[:] = 11
        (tmp_path / f"part-{n}").write_bytes(tokens.astype(kind).tobytes())
        ends = np.flatnonzero(tokens == 9).tolist()
        if tokens[-1] != 9:
            ends.append(60)
        want += [(n, a, b - a) for a, b in zip([0] + [e + 1 for e in ends], ends)]
    (tmp_path / "part-4").write_bytes(b"")
    got = [(int(r["file"][-1]), r["start"], r["n_tokens"]) for r in T.token_counts(spark, str(tmp_path), kind, 9, 0, block).collect()]
    assert sorted(got) == sorted(want)


def test_ids_are_spelled_without_the_separator():
    for x in (None, 0, 1, -1, 2 ** 63 - 1, -2 ** 63, 50256):
        digits = T.spell(x, 50256)
        assert max(digits) < 50256 and T.unspell(np.array([digits]), 50256) == [x]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert T.op3_token_counts(spark, str(tmp_path)).collect() == []


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "FILE_BYTES", 4000)
    rows = [(k, "the in " * (k % 7 * 50)) for k in range(300)] + [(900, "the " * 9000), (901, ""), (902, None)]
    path = str(tmp_path / "files")
    T.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path)
    sizes = sorted(f.stat().st_size for f in (tmp_path / "files").glob("part-*"))
    assert len(sizes) > 20 and sizes[-2] <= 4000 < sizes[-1] < 18_100
    kind, end = T.token_type(TOKENIZER)
    tok = Tokenizer.from_file(TOKENIZER)
    want = sorted((d, len(tok.encode(t or "").ids)) for d, t in rows)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in T.token_counts(spark, path, kind, end, T.HEADER, 64).collect()) == want
