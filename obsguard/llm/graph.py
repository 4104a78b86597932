"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's smallest node.

    Each round points all larger neighbours of a node at its least neighbour, then all smaller ones; both
    keep the components and reach stars in about log2 of the diameter. Minima are pre-aggregated, and
    the join of a node's edges to its minimum may be split where a node has very many.
    """
    pairs = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        pairs = stored(small.where("a <> b").distinct(), "small-star")
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before is not None and (now["n"], now["h"]) == before:
            break
        before = (now["n"], now["h"])
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
