"""Connected components of a graph given as edges, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.common import written


MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node, component for the nodes of ``edges`` (a, b); the component is its smallest node.

    Each round moves every node's larger neighbours, then its smaller ones, to
    the smallest neighbour, which needs a number of rounds that grows with the
    logarithm of the longest path. A round is written out, so a lost executor
    costs a re-read. Neighbours are reduced in the partial aggregate, and the
    join back has one row per node on one side, so a node with very many
    neighbours is split like any skewed join.
    """
    current = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "cc-edges"
    )
    before = None
    for _ in range(MOST_ROUNDS):
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = written(large, "cc-large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(lowest, "u")
        small = (
            linked.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        current = written(small, "cc-small")
        # order-free digest of the edges: unchanged means every edge leads to its component's smallest node
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if before == (state["n"], state["h"]):
            break
        before = (state["n"], state["h"])
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots).distinct()
