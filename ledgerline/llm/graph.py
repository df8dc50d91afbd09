"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import written


def _stars(edges: DataFrame) -> DataFrame:
    """One round over edges ``(u, v)``, u > v; every node moves towards its smallest neighbour.

    The minima are aggregated before they are joined, so the join is all that meets a hot node,
    and Spark can split it.
    """
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.join(least, "u").where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.where(F.col("u") != F.col("v")).unionAll(least.toDF("u", "v")).distinct()


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``(node, component)``, the smallest node of the component, for nodes that have an edge.

    Every round is written to the shared folder, which cuts the lineage. The number of rounds
    grows with the logarithm of the length of chains.
    """
    u, v = F.col(src), F.col(dst)
    edges = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    edges, before = written(edges.distinct(), "edges"), None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before, edges = state, written(_stars(edges), "edges")
    own = edges.select("v").distinct().select("v", F.col("v").alias("component"))
    return edges.toDF("node", "component").unionAll(own.toDF("node", "component"))
