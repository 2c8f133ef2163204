"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every step is a grouped minimum
(combined before the shuffle) and a join on the node, whose skewed partitions
Spark splits, so a node with very many links is no bottleneck. Nothing but a
row of three numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): each node of ``edges`` (u, v) and the smallest node it reaches.

    Nodes without edges aren't in the result; repeated edges, loops and edges
    with a null end are allowed and count for nothing.
    """
    stage = Stage(edges.sparkSession, name)
    big, small = F.greatest("u", "v"), F.least("u", "v")
    now = edges.where("u is not null and v is not null and u <> v").select(big.alias("u"), small.alias("v")).distinct()
    now = stage.write(now, "edges-0")
    mark, k = _mark(now), 0
    while mark[0]:
        after = stage.write(_small_star(_large_star(now)), f"edges-{k + 1}")
        stage.drop(f"edges-{k}")
        k, was, mark, now = k + 1, mark, _mark(after), after
        if mark == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of a set of edges: number, and sums of two hashes."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
