"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.session import drop_stage, stage


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = e.union(e.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) of every node with an edge to another.

    ``edges`` are two columns of numbers; loops and repeats do no harm; no edges
    give no rows.  Links stay distributed: each round is a written table in the
    shared folder, and the driver sees only its checksum.
    """
    a, b = edges.columns
    e = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            out = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            out._daycast_stage = e._daycast_stage
            return out
        mark = tuple(now)
        old, e = e, stage(_small_star(_large_star(e)), "links")
        drop_stage(old)
