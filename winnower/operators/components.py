"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnower.storage import written


def _told(edges: DataFrame, least: DataFrame, larger: bool) -> DataFrame:
    """Edges from every neighbour on one side of a node to the least node that it knows."""
    side = F.col("v") > F.col("u") if larger else F.col("v") < F.col("u")
    return (
        edges.filter(side)
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .filter("u <> v")
    )


def connected_classes(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node: the least node that it reaches.

    Rounds of two steps, until no edge changes: each node tells its larger
    neighbours the least node it knows, then its smaller ones. A node of very many
    neighbours is summed in the map tasks, so it weighs on no single task, and the
    rounds needed grow with the logarithm of a chain's length.
    """
    spark = links.sparkSession
    edges = written(
        spark,
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
        "edges",
    )
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = written(spark, _told(both, least, larger=True).distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        own = least.select("u", F.col("low").alias("v"))
        edges = written(spark, _told(large, least, larger=False).union(own).distinct(), "edges")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
