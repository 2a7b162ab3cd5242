"""Connected components of links between long ids, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import Scratch


def labels(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, label`` (the smallest node of its component) for every node of ``links`` (``x, y``).

    Large-star and small-star steps in turn: each hangs neighbours onto the smallest one known, and after a number
    of rounds that grows with the logarithm of the longest path all nodes hang on their smallest.  A node with very many
    links is aggregated before any shuffle, and is one row on the other side of the join."""
    both = lambda e: e.union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
    edges = scratch.keep(links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), f"{name}-0")
    last, turn = None, 0
    while True:
        around = both(edges)
        least = around.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = around.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        small = large.where("x <> y").distinct()
        least = small.groupBy("x").agg(F.min("y").alias("m"))
        hung = small.join(least, "x")
        hung = hung.select(F.col("y").alias("x"), F.col("m").alias("y")).union(hung.select("x", F.col("m").alias("y")))
        turn += 1
        edges = scratch.keep(hung.where("x <> y").distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return edges.select(F.col("x").alias("node"), F.col("y").alias("label")).union(
        edges.select(F.col("y").alias("node"), F.col("y").alias("label")).distinct()
    )
