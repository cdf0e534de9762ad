"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gustline.session import stage


def _neighbours_to(edges: DataFrame) -> DataFrame:
    """Both directions of each edge."""
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Each round hangs larger neighbours, then smaller ones, below the smallest neighbour
    (Kiveris et al., "Connected components in MapReduce and beyond"): a number of rounds
    that grows with the logarithm of the size, not with the length of a chain. Minima are
    combined before the shuffle and stars are joined, never gathered, so a hub's edges stay
    spread and adaptive execution can split it. Each round is written to the shared folder.
    Self loops and repeated edges change nothing; an empty table gives an empty table.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b").distinct(),
        "edges",
    )
    before = None
    while True:
        both = _neighbours_to(now)
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        # every edge now runs from a node to a smaller one; each node keeps its smallest
        # and passes the others to it
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(low, "a")
        small = linked.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.join(now.select(F.col("a").alias("node")), "node", "left_anti")
    )
