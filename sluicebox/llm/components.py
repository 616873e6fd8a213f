"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.work import stored
from sluicebox.operators.skew import unique_side


def _linked_to_least(edges: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` with ``least``, the smallest of u and all its v. A hot u is aggregated before it is shuffled."""
    least = unique_side(edges, "u", F.min("v").alias("near"))
    return edges.join(least, "u").select("u", "v", F.least("u", "near").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node near it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _linked_to_least(both).where("v > u")
    return found.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges have u > v."""
    found = _linked_to_least(edges)
    links = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
    return links.where("u > v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node that has a link to another.

    Each round is written, so a lost executor costs one round. The rounds end when the stars no longer change; their
    number grows with the logarithm of the longest path. Links may repeat; those with a NULL are ignored.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stored(links.where(f"{a} <> {b}").select(u, v).distinct(), "links")
    before = None
    while True:
        # Two different sets of edges with one count and one sum of hashes would end the rounds early.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        # Stars: every node has one edge, and no centre has any.
        if state == before or state[0] == 0:
            break
        before = state
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
