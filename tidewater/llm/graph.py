"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a join, so a node with very
many links is never gathered in one place. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v), each in both directions where wanted, to edges (v, least neighbour of u)."""
    least = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``links`` (a, b) to (node, component): the least node that can be reached, for every node with a link."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = work.write(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _star(large)
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        following = work.write(moved.distinct(), "edges")
        now = following.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        work.drop(edges)
        edges = following
        if (now.n, now.h) == state:
            break
        state = (now.n, now.h)
    # every edge now leads to the least node of its component
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
