"""Connected components of a table of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to its least one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every linked node that is not the least of its component; ``links`` has columns a and b.

    Alternates the two star steps until each node points at the least of its component. A hub costs one aggregated row
    and its own edges per step. Every step's edges are written.
    """
    edges = scratch.put(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    seen = None
    while True:
        stars = scratch.put(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        scratch.drop(edges)
        edges = stars
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if now == seen:
            final = scratch.put(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "roots")
            scratch.drop(edges)
            return final
        seen = now
