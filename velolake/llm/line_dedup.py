"""Line dedup: hash exploded normalised lines, count documents per hash, drop, reassemble.

Main path is DataFrame functions only.  Only (hash, doc) rows and line positions are
shuffled for the counting; texts move once, to meet their list of dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm.common import ASCII_SPACE, ascii_lower, materialize, read_table

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop lines whose key occurs in ``min_docs`` documents, but for the largest doc_id.

    Returns the input's columns with ``text`` replaced by the kept lines, in a struct column
    ``row``, and the longs ``n_lines`` and ``n_dropped``.  Every line of a dropped key goes;
    in the largest doc_id that holds the key all its lines stay.

    Nulls and odd input: a null or empty text is one empty line and stays as it is read, as
    the empty text.  A null doc_id is one document below all others.  Rows that share a
    doc_id are one document; each is rewritten by its own lines.  Other columns are carried
    untouched, whatever their names.  An empty table gives an empty result.

    Keys are compared by 128 bits of hash.  A line that very many documents share is counted
    by partial aggregates, and the join that brings the verdict back has one row per key on
    one side, so a hot key can be split.
    """
    rows = docs.select(F.struct("*").alias("row"))
    ident = [F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("th")]
    key = line_key(F.col("line"))
    lines = (rows.select(*ident, F.posexplode(_lines(F.col("row.text"))).alias("pos", "line"))
             .where(F.length("line") >= min_chars)
             .select("doc_id", "th", "pos", key.alias("key"))
             .where(F.length("key") >= min_chars)
             .select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(7), "key").alias("h2")))
    # Written, as Spark splits a hot key of a join only if both sides come straight from a shuffle.
    over = materialize(lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
                       .groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("keep"))
                       .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keep"), "line-keys")
    drops = (lines.join(over, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keep")))
             .groupBy("doc_id", "th").agg(F.collect_set("pos").alias("drop"))
             .select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "drop"))
    met = rows.select("row", *ident).join(
        drops, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t")), "left")
    # The generator keeps the split array as one value; inside the lambda below it would be
    # split again for every kept line.
    apart = met.select("row", "drop", F.explode_outer(F.array(_lines(F.col("row.text")))).alias("lines"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.when(F.col("drop").isNull(), F.coalesce(F.col("row.text"), F.lit(""))).otherwise(
        F.array_join(F.transform(F.array_except(places, F.col("drop")),
                                 lambda i: F.get(F.col("lines"), i)), "\n"))
    return apart.select(
        F.col("row").withField("text", kept).alias("row"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("row.text", 256).alias("kept_sha256"))


OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos
        FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM d))),
o AS (SELECT k, max(doc_id) AS keep FROM l WHERE length(k) >= {MIN_CHARS}
      GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
f AS (SELECT l.doc_id, l.pos, l.line, o.k IS NOT NULL AND l.doc_id <> o.keep AS gone
      FROM l LEFT JOIN o ON l.k = o.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
