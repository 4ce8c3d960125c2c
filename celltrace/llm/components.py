"""Connected components of a link table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltrace.llm.scratch import Scratch


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    A round moves every node to the smallest neighbour of its neighbourhood; rounds go on until the table of
    links stays the same. Groups are only ever reduced to a minimum, so a node with very many links is no burden.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Link the larger (or the smaller and equal) neighbours of every node to the smallest of them all."""
        both = edges.select("a", "b") if not large else edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")) if large else both.groupBy("a").agg(F.min("b").alias("m"))
        if large:
            moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return moved.filter("a != b").distinct()

    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    mark, turn = None, 0
    while True:
        edges = scratch.cut(edges, f"{name}-{turn}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if turn:
            scratch.drop(f"{name}-{turn - 1}")
        if now == mark:
            break
        mark, turn = now, turn + 1
        edges = star(star(edges, True), False)
    # every link now leads to the smallest node of its component
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
