"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them (edges have u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v long); component is its smallest node.

    Both steps are a grouping with map-side minima and a join that AQE can split at a hot node.
    Each round is written to the shared folder.  An edge from a node to itself only names the
    node.  An empty table gives no rows.  Rounds end when a round changes nothing.
    """
    named = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    nodes = named.select(F.col("u").alias("node")).union(named.select("v"))
    now = written(named.where("u <> v").distinct(), "stars")
    nodes = written(nodes.distinct(), "nodes")
    state = None
    for _ in range(MAX_ROUNDS):
        after = written(_small_star(_large_star(now)), "stars")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = after
        if mark == state:
            break
        state = mark
    else:
        raise RuntimeError("components did not settle")
    return (nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))
