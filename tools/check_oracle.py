"""Run named queries in Spark and their SQL in DuckDB on the same tables; compare.

Usage: python tools/check_oracle.py [--plain-session] [sf_dir] [name ...]

Compares row count, column names, and the sorted multiset of rows with exact values
(timestamps as naive UTC, floats bit-for-bit).  Prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from velolake.plans.registry import all_oracles, all_queries  # noqa: E402
from velolake.session import build_session  # noqa: E402
from velolake.sources.tables import DRIVER_TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None) if v.tzinfo is None else v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple(str(x) for x in r))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(df, description):
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in description}
    return {k: (spark_types[k], duck_types.get(k)) for k in spark_types if spark_types[k] != duck_types.get(k)}


def main(argv):
    plain = "--plain-session" in argv
    argv = [a for a in argv if a != "--plain-session"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    if plain:   # a session as a caller might build it: Spark defaults only
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracles = all_queries(), all_oracles()
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in oracles:
            print(f"{name:45s} rows-only  spark={len(srows)}  {t1 - t0:.1f}s")
            continue
        res = con.execute(oracles[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        scols, sr = rows_of(df.columns, srows)
        dcols2, dr = rows_of(dcols, drows)
        status = "OK"
        detail = ""
        tm = type_mismatches(df, res.description)
        if scols != dcols2:
            status, detail = "COLS", f"spark={scols} duck={dcols2}"
        elif tm:
            status, detail = "TYPES", str(tm)
        elif len(sr) != len(dr):
            status, detail = "COUNT", f"spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            diffs = [(a, b) for a, b in zip(sr, dr) if a != b]
            status, detail = "VALUES", f"{len(diffs)} differ, e.g. spark={diffs[0][0]} duck={diffs[0][1]}"
        if status != "OK":
            bad += 1
        print(f"{name:45s} {status:6s} rows={len(sr)} {t1 - t0:.1f}s {detail}"[:600])
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
