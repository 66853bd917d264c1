"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import cut, split_join


def _to_least(edges: DataFrame) -> DataFrame:
    """Every (u, v) with the least of u and its neighbours; the minimum combines map-side, so a hot u is fine."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return split_join(edges, least, ["u"])


def connected(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of the undirected ``edges`` (u, v): root is the least node of its component.

    Each round is a job whose edges are checkpointed; rounds grow with the logarithm of the longest path.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _to_least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
