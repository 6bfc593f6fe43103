"""Secret scan: fixed patterns, and runs that a Markov model of random strings explains better.

DataFrame functions only; every row is scanned where it is read and nothing is shuffled but
the counts of the two models.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velolake.llm.common import read_table
from velolake.llm.minhash import once

# Fixed values of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RANDOM = ("hex", "upper", "mixed")  # labels of random strings, by alphabet
BACKOFF = 16.0          # characters of plain frequency that every state is given
START = len(ALPHABET)   # the state before the first character
MIN_RUN = 20            # characters of a run that the models judge
MIN_RATE = 1.0          # nats a character by which "random" must lead
SAMPLE_DOCS = 2000      # documents whose strings train the models, by smallest hash of the id

_CLASS = "[A-Za-z0-9+/_-]"
RUN = rf"(?<!{_CLASS}){_CLASS}{{{MIN_RUN},}}"
ORDINARY = rf"(?<!{_CLASS}){_CLASS}{{6,}}"
RULE = 40               # characters of a rule of one repeated character, at most
JOINTS = "/-_"          # what words are joined by in paths, titles and names


def _prefix_sums(values: Column, block: int = 256) -> Column:
    """Running sums of an int array, in blocks, as appending to one array would copy it for
    every element."""
    empty = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("s"), empty.alias("a"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
                         lambda k: F.slice(values, k * block + 1, block))
    inner = F.transform(blocks, lambda b: F.aggregate(
        b, start, lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"] + x)).alias("a"))))
    joined = F.aggregate(
        inner, F.struct(F.lit(0).alias("s"), F.array().cast("array<array<int>>").alias("a")),
        lambda acc, b: F.struct((acc["s"] + b["s"]).alias("s"), F.concat(
            acc["a"], F.array(F.transform(b["a"], lambda x: x + acc["s"]))).alias("a")))
    return F.when(F.size(values) == 0, empty).otherwise(F.flatten(joined["a"]))


def located(df: DataFrame, text: str, pattern: str, out: str, group: int = 0, where: Column | None = None) -> DataFrame:
    """Add ``out``: (start, end, value) of the leftmost non-overlapping matches, in code points.

    ``value`` is the named group.  The text between the matches and the matches alternate,
    so running sums of their lengths are the positions.  ``where`` tells which texts can
    match at all.
    """
    kept = [c for c in df.columns if c != out]
    none = F.array().cast("array<string>")

    def guarded(column: Column) -> Column:
        return once(column if where is None else F.when(where, column).otherwise(none))

    df = df.select(*kept, guarded(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("_m"))
    found = F.size("_m") > 0
    value = F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none) if group else F.col("_m")
    df = df.select(*kept, "_m", once(value).alias("_v"),
                   F.when(found, F.split(text, pattern, -1)).otherwise(none).alias("_g"))
    df = df.select(*kept, "_m", "_v", once(F.slice(
        F.zip_with("_g", "_m", lambda g, m: F.length(g) + F.length(m)), 1, F.size("_m"))).alias("_n"))
    df = df.select(*kept, "_m", "_v", once(_prefix_sums(F.col("_n"))).alias("_e"))
    return df.select(*kept, once(F.transform("_m", lambda m, i: F.struct(
        (F.get(F.col("_e"), i) - F.length(m)).alias("start"), F.get(F.col("_e"), i).alias("end"),
        F.get(F.col("_v"), i).alias("value")))).alias(out))


def blanked(text: Column, spans: str) -> Column:
    """``text`` with spaces in place of the spans of an array that ``located`` made."""
    def stop(i: Column) -> Column:
        return F.when(i == 0, 0).otherwise(F.get(F.col(spans), i - 1)["end"])

    parts = F.transform(spans, lambda m, i: F.concat(
        F.substring(text, stop(i) + 1, m["start"] - stop(i)), F.repeat(F.lit(" "), m["end"] - m["start"])))
    rest = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(parts, ""), rest))


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Add arrays ``assign``, ``access``, ``hex`` of the spans that are long enough, and
    ``masked``, the text with every assign match and these spans blanked out."""
    t = F.col(text)
    df = located(df, text, ASSIGN, "assign", 2, t.contains("=") | t.contains(":"))
    df = located(df, text, ACCESS, "access", 0, t.contains("AKIA"))
    # A run of hex digits is found whole or not at all, so short ones can be left out early.
    df = located(df, text, rf"[0-9a-f]{{{LEAST['hex']},}}", "hex", 0, t.rlike(rf"[0-9a-f]{{{LEAST['hex']}}}"))
    df = df.withColumn("masked", once(blanked(t, "assign")))
    for kind, least in LEAST.items():
        df = df.withColumn(kind, F.filter(kind, lambda m: F.length(m["value"]) >= least))
    for kind in ("access", "hex"):
        df = df.withColumn("masked", once(blanked(F.col("masked"), kind)))
    return df


def _index(text: Column) -> Column:
    """Number of each character of a string of the alphabet."""
    return F.transform(F.split(text, ""), lambda c: (F.instr(F.lit(ALPHABET), c) - 1))


def transitions(strings: DataFrame) -> DataFrame:
    """(label, a, b, n): how often character ``b`` follows ``a`` in the strings of a label."""
    pairs = strings.select("label", _index(F.col("s")).alias("i")).select("label", F.explode(F.zip_with(
        F.concat(F.array(F.lit(START)), F.slice("i", 1, F.greatest(F.size("i") - 1, F.lit(0)))), "i",
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    return pairs.groupBy("label", "p.a", "p.b").agg(F.count("*").alias("n"))


def log_ratios(counts: list[tuple[str, int, int, int]]) -> dict[str, list[float]]:
    """For each random label log P(b | a, label) - log P(b | a, ordinary), row by row of ``a``.

    A state with few observations leans on the label's character frequencies, as if it had
    seen ``BACKOFF`` characters of them; these are add-one smoothed.
    """
    size = START
    seen = {label: [[0] * size for _ in range(size + 1)] for label in (*RANDOM, "ordinary")}
    for label, a, b, n in counts:
        seen[label][a][b] += n
    logs = {}
    for label, rows in seen.items():
        freq = [1 + sum(row[b] for row in rows) for b in range(size)]
        logs[label] = [math.log((row[b] + BACKOFF * freq[b] / sum(freq)) / (sum(row) + BACKOFF))
                       for row in rows for b in range(size)]
    return {label: [x - y for x, y in zip(logs[label], logs["ordinary"])] for label in RANDOM}


def labelled_strings(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(label, s): distinct labelled strings of at most ``sample_docs`` documents.

    Random strings are labelled by their alphabet: hex, upper (capitals and digits) or mixed.
    They are what the fixed patterns find, and the digest of each document's id in hex, in
    base 36 and in base 64, as such tokens are made from random bytes.  Ordinary are the
    texts' runs of the judged characters outside of these matches, and each joined to another one
    and to a number, as paths and names of every common form are made from words whether or not the
    sampled texts hold any; rules of one repeated character; and strings of bases.
    """
    mark = F.xxhash64("doc_id")
    top = docs.select(mark.alias("h")).orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    some = docs.where(mark <= F.lit(top)) if top is not None else docs.limit(0)
    found = base_spans(some.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text")
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    made = F.array(F.substring(digest, 1, 40), F.rtrim(F.base64(F.unhex(digest)), F.lit("=")),
                   F.conv(F.substring(digest, 1, 15), 16, 36), F.conv(F.substring(digest, 17, 15), 16, 36))
    values = F.concat(*[F.transform(k, lambda m: m["value"]) for k in LEAST], made)
    plain = F.regexp_extract_all("masked", F.lit(ORDINARY), F.lit(0))
    cut = F.regexp_replace("s", "[^A-Za-z0-9+/_-]", "")
    kind = F.when(F.col("s").rlike("^[0-9a-f]+$"), "hex").when(F.col("s").rlike("^[0-9A-Z]+$"), "upper").otherwise("mixed")
    random = found.select(F.explode(values).alias("s")).select(cut.alias("s")).select(kind.alias("label"), "s")
    words = found.select(F.explode(plain).alias("s")).distinct()
    joint = F.substring(F.lit(JOINTS), F.pmod(F.xxhash64("s"), F.lit(len(JOINTS))).cast("int") + 1, F.lit(1))
    number = F.pmod(F.xxhash64(F.lit(1), "s"), F.element_at(
        F.array(*map(F.lit, (10, 100, 10_000))), F.pmod(F.length("s"), F.lit(3)) + 1)).cast("string")
    # Names are made from neighbouring words of the sample, in the forms that code has them in.
    by_bucket = Window.partitionBy(F.pmod(F.xxhash64("s"), F.lit(64))).orderBy(F.xxhash64(F.lit(2), "s"), "s")
    pairs = words.select("s", F.coalesce(F.lead("s").over(by_bucket), F.col("s")).alias("t"))
    low, up, cap = F.lower, F.upper, lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))
    names = [F.concat(cap("s"), cap("t")), F.concat(low("s"), cap("t")), F.concat(up("s"), F.lit("_"), up("t")), F.concat(low("s"), F.lit("_"), low("t")),
             F.concat(low("s"), F.lit("_v"), number), F.concat(low("t"), up(F.substring("s", 1, 2)), F.lit("_"), low("s")), F.concat(up("t"), joint, number)]
    ordinary = pairs.select(F.explode(F.array("s", F.concat("s", joint, "t"), F.concat("s", joint, number, joint, "t"), *names)).alias("s"))
    # Rules of one character, and strings of the four letters of bases, fewer than the names.
    size = (F.lit(6) + F.pmod(F.xxhash64(F.lit(3), "s"), F.lit(RULE - 5))).cast("int")
    head = F.substring("s", 1, 1)
    rules = words.select(F.explode(F.array(F.repeat(head, size), F.repeat(up(head), size), F.repeat(joint, size))).alias("s"))
    bases = words.where(F.pmod(F.xxhash64(F.lit(4), "s"), F.lit(32)) == 0).select(
        F.substring(F.translate(F.sha2("s", 256), "0123456789abcdef", "ACGT" * 4), 1, RULE).alias("s"))
    plain = ordinary.union(rules).union(bases).select(F.lit("ordinary").alias("label"), "s")
    return random.union(plain).where("s <> ''").distinct()


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, list[float]]:
    """The tables of log ratios, one number for each pair of characters."""
    return log_ratios([tuple(r) for r in transitions(labelled_strings(docs, sample_docs)).collect()])


def log_ratio(text: Column, tables: dict[str, list[float]]) -> Column:
    """Log-likelihood ratio of a string of the alphabet: the best random model's lead."""
    i = _index(text)
    steps = F.zip_with(F.concat(F.array(F.lit(START)), i), i, lambda a, b: a * START + b)

    def lead(table: list[float]) -> Column:
        weights = F.expr("array(" + ",".join(f"{x:.6f}D" for x in table) + ")")
        return F.aggregate(steps, F.lit(0.0), lambda acc, k: acc + F.coalesce(F.get(weights, k), F.lit(0.0)))

    return F.greatest(*map(lead, tables.values()))


def scan(docs: DataFrame, tables: dict[str, list[float]], min_rate: float = MIN_RATE) -> DataFrame:
    """The input's rows in a struct ``row``, with the arrays ``assign``, ``access``, ``hex``
    and ``markov`` of (start, end, value) in code points.

    ``markov`` holds the runs of at least ``MIN_RUN`` letters, digits and +/_- outside of
    all other spans whose ratio is at least ``min_rate`` a character.

    A null text is empty; a text of any length is read whole; repeated rows are scanned
    each; null ids and other columns are carried; an empty table gives an empty result.
    """
    df = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    df = base_spans(df, "text").drop("text")
    df = located(df, "masked", RUN, "run", 0, F.col("masked").rlike(RUN)).drop("masked")
    markov = F.filter("run", lambda m: log_ratio(m["value"], tables) >= min_rate * F.length(m["value"]))
    return df.withColumn("markov", markov).drop("run")


def span_texts(kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then by place in ``kinds``, joined by commas."""
    def placed(n: int, kind: str) -> Column:
        return F.transform(kind, lambda m: F.struct(
            m["start"].alias("start"), F.lit(n).alias("n"), F.concat_ws(":", F.lit(kind), m["start"], m["end"]).alias("t")))

    spans = F.concat(*[placed(n, kind) for n, kind in enumerate(kinds)])
    return F.array_join(F.transform(F.sort_array(spans), lambda m: m["t"]), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    base = list(LEAST)
    return found.select(
        "row.doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(span_texts(base), 256).alias("base_sha256"), span_texts([*base, "markov"]).alias("spans"),
        F.size("markov").cast("long").alias("n_markov"))
