"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from syncspark.workspace import stage


# From so many links on, smallest neighbours are written before they are joined.
_MANY_LINKS = 1_000_000


def _hub(least: DataFrame, many: bool) -> DataFrame:
    """Smallest neighbours as a table of their own where there are many.

    Star contraction hangs very many nodes on one. Both sides of a join being
    tables, adaptive execution can split such a node's links, or broadcast the other side.
    """
    return stage(least, "least") if many else least


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges (``a``, ``b``): the smallest node it can reach.

    Alternating star contraction: each round hangs larger neighbours, then
    smaller ones, on the smallest node known. Every round is written to the
    shared folder; only a count and a checksum come to the driver. An edge from
    a node to itself names a component of one.
    """
    loops = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    known = None
    many = links.limit(_MANY_LINKS).count() == _MANY_LINKS
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _hub(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), many)
        large = both.join(least, "a").where("b > a").select(F.col("least").alias("a"), "b").where("a <> b").distinct()
        large = _hub(large, many)
        # All links now lead from a smaller to a larger node.
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = _hub(down.groupBy("a").agg(F.min("b").alias("least")), many)
        small = down.join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y")).union(least.select("a", "least"))
        links = stage(small.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    roots = links.groupBy("b").agg(F.min("a").alias("root"))
    return loops.join(roots, loops["node"] == roots["b"], "left").select("node", F.coalesce("root", "node").alias("component"))
