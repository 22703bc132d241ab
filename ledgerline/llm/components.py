"""Connected components of a graph given by its edges, as joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it reaches.

    Each round points the larger neighbours of a node at its smallest one, then the smaller
    ones; the number of rounds grows with the logarithm of the graph. Stops when a round
    changes no edge. Edges must be numbers of one type; loops are ignored.
    """
    links = stored(_directed(edges), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        links = stored(_small_star(_large_star(links)), "edges")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node, tied to the smallest of the node and its neighbours."""
    both = links.union(links.select("b", "a"))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, tied to the smallest of them."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    tied = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low)
    return tied.where("a <> b").distinct()
