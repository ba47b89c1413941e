"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` holds ``a`` and ``b`` (longs); returns ``node`` and ``root``, the smallest node it reaches.

    Each step hangs a node's neighbours under the smallest of them; every table is written to the
    shared folder before the next step, and the loop ends when a step changes nothing. The number
    of rounds grows with the logarithm of the longest chain. A node of very many edges is only ever
    a key of a pre-aggregated minimum and of a join that Spark can split. Self-loops and repeated
    edges do no harm; nodes without an edge are not in the result.
    """
    edges = stage(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        under = large.join(least, "a")
        small = under.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = stage(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
