"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import materialise


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node reachable.

    Each round points the larger neighbours of a node, then its smaller ones, to its smallest
    neighbour. Minima are partially aggregated, and a hot node's links can be split, so no
    group is gathered; the rounds grow with the logarithm of the longest path. Rounds are
    written to shared storage. Raises if `most_rounds` doesn't suffice.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("component")))
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
