"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v.

    Each node u has a least neighbour m (itself included). Large-star links the larger
    neighbours of u to m, small-star the smaller ones and u itself. The least neighbour is a
    partial aggregate joined back, so no task gathers the neighbours of a hub; a hub's edges
    are an ordinary join side that adaptive skew joins can split.
    """
    swapped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(swapped) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = near.join(least, near.u == least.w)
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is the centre of its links or has one link, to a centre."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.where("out > 1 or (out = 1 and into = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Least reachable node of every node that has an edge: (node, component).

    ``edges`` has long columns a and b in any order; loops, repeats and rows with nulls are
    ignored. No edges give no rows. Steps alternate until only stars are left; each is written
    to the shared folder, and only whether that is so goes to the driver.
    """
    state = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    while not _are_stars(state):
        state = stage(_star(stage(_star(state, True), "large-star"), False), "small-star")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select("v", "v").distinct().toDF("node", "component"))
