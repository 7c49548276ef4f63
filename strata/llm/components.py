"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import saved, scalar, scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-large-min")
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = saved(down.groupBy("u").agg(F.min("v").alias("m")), "cc-small-min")
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(u, v)`` links -> ``(node, component)`` for every node that has a link.

    ``component`` is the smallest node reachable. Each star is a partial minimum
    by node and a join that AQE can split, so a node with very many links isn't
    one task's work. Every round is written to the checkpoint folder. Self links
    and links with a null end are ignored; an empty table gives an empty one.
    """
    with scratch(links.sparkSession) as keep:
        edges = saved(links.where("u != v").select(F.greatest("u", "v").alias("u"),
                                                   F.least("u", "v").alias("v")).distinct(), "cc-links")
        digest = None
        for _ in range(max_rounds):
            edges = saved(_small_star(saved(_large_star(edges), "cc-large")), "cc-small")
            now = scalar(edges, F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
            if now == digest:
                break
            digest = now
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        keep(edges)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
