"""Connected components as joins: alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) of every node that an edge ``a``, ``b`` of longs touches.

    Large and small stars alternate until no edge changes (Kiveris et al., 2014), in about log(diameter)
    rounds.  A node's neighbours are never gathered: their minimum is aggregated and joined back, so a
    node of any degree is spread by partial aggregation and skewed joins.  Null ends and loops are left out.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last = None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        # large star: larger neighbours of a node go to the node's smallest neighbour
        ways = _both_ways(edges)
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours of a node, and the node, go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = materialize(small.where("a <> b").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
