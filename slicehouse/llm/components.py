"""Connected components of an edge list that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicehouse.llm.common import discard, persisted


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """One row (node, root) for every node of ``edges`` (u bigint, v bigint); root is the smallest node of its component.

    Large-star and small-star rounds in turn, each written to the shared folder, until nothing changes. A node with very
    many neighbours is reduced to its smallest one on the map side, and the join with that one row may be split by
    adaptive execution. Self-links and repeated links are allowed; an edge list without rows gives no rows.
    """
    linked = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    links = persisted(linked.filter("u >= v").distinct())
    before = None
    for _ in range(max_rounds):
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, old = state, links
        links = persisted(_small_star(_large_star(links)))
        discard(old)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v"), F.col("v"))
    ).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours larger than a node are linked to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
