import hashlib
import struct
from collections import defaultdict

from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm.test_decontamination import distances
from tests.llm.test_simhash import brute_components, brute_print
from velolake.llm import bpe, decontamination, language_id

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(spark, docs, benchmark):
    """The stages in plain Python; of language ID only the model is taken from the library."""
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.train(df)  # the stage holds no document out
    n, score = model.scores([t for _, t, _ in docs])
    kept = [(d, t) for (d, t, _), k, s in zip(docs, n, score) if k and s.max() >= language_id.MIN_SCORE]
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for d, t in kept:
        for line in t.split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(d)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    kept = [(d, "\n".join(x for x in t.split("\n") if gone.get(key(x), d) == d)) for d, t in kept]
    comp = brute_components([(d, brute_print(t)) for d, t in kept])
    kept = [(d, t) for d, t in kept if comp[d] == d]
    out = []
    tok = Tokenizer.from_file(bpe.TOKENIZER)
    for d, t in kept:
        text = decontamination.normalise(t)
        items = [decontamination.normalise(x) for x in benchmark]
        if any(i in text or (len(text) < 1500 and min(distances(i, text)) <= int(0.05 * len(i))) for i in items if i):
            continue
        ids = tok.encode(t, add_special_tokens=False).ids
        out.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                    hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def test_run_against_brute_force(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    line = "This line is the same in many of the documents of the table."
    docs = [(d, t + "\n" + line if d % 7 == 0 else t, *x) for d, t, *x in docs[:90]]
    docs += [(900, "12 34 !", "en", "s", 7), (901, "", "en", "s", 0), (902, None, "en", "s", None), (903, docs[5][1], "en", "s", 1)]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()][:8]
    docs += [(910 + k, f"{docs[k + 8][1][:300]} {bench[k][1]} {docs[k + 9][1][:100]}", "en", "s", 1) for k in range(3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuple(r) for r in P.run(spark, str(tmp_path)).collect())
    want = brute(spark, [d[:3] for d in docs], [t for _, t in bench])
    assert got == want and 20 < len(want) < len(docs)


def test_stages_keep_the_columns_and_stand_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], schema)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert P.STAGES[-1][1](spark, docs, str(tmp_path)).collect() == []
