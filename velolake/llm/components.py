"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _lowest(edges: DataFrame) -> DataFrame:
    """Written, as Spark splits a hot key of a join only if both sides come straight from a shuffle."""
    return materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "star-low")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    around = _both(edges)
    low = _lowest(around).withColumn("m", F.least("a", "m"))
    return around.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = _lowest(down)
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reached.

    Each round is written to the shared folder.  The number of rounds is logarithmic in the
    longest path.  A star's centre is a hot key: its minimum is pre-aggregated and the join
    that returns it has one row per node on the other side, so Spark can split it.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), label)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = materialize(_small_star(_large_star(now)), label)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
