"""Connected components by joins: every node of an edge list and the smallest node it reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from phraseloom.llm.scratch import Scratch


def _least(edges: DataFrame) -> DataFrame:
    """For every node, the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for the nodes of undirected edges (u, v), by alternating large-star and small-star steps.

    Each step links neighbours of a node to its smallest neighbour, an aggregate with a map-side step and a join, so
    no neighbourhood is gathered anywhere, and a component of N nodes settles in about log(N) rounds.
    """
    have = scratch.write(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0"
    )
    state, k = None, 0
    while True:
        both = have.unionByName(have.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        large = scratch.write(large.distinct(), f"{name}-large{k}")
        down = large.filter("v < u")
        low = _least(down)
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        small = small.unionByName(low.select("u", F.col("_m").alias("v"))).filter("u <> v").distinct()
        next_ = scratch.write(small, f"{name}-{k + 1}")
        now = next_.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}-{k}", f"{name}-large{k}")
        if now == state:
            return next_.select(F.col("u").alias("node"), F.col("v").alias("component"))
        have, state, k = next_, now, k + 1
