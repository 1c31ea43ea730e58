"""Connected components of links, as labels that spread by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braid.shared import discard, written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node that ``links`` (a, b) name; the root is the least node of its component.

    Each round hangs every node and its neighbours below the least node in sight (large and small stars in turn), which
    halves long chains; rows are written between rounds, so that no round depends on the memory of an executor.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        # Large star: neighbours above a node go to the least one around it. Small star: those below do, and the node itself.
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")
        small = large.join(least, F.col("u") == F.col("of"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("of").alias("u"), F.col("m").alias("v")))
        done, edges = edges, written(small.filter("u <> v").distinct(), "small_star")
        discard(done)
        discard(large)
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
