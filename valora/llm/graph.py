"""Connected components of an edge table, by alternating stars.

Each round is two groupings and joins; the edges are written to the shared
checkpoint folder between rounds, and only two numbers (their count and a sum
of hashes) reach the driver, to see whether they still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.llm.session import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v), u > v.  Large star: links the larger neighbours of a
    node to the least of its neighbourhood; small star: the smaller ones."""
    near = edges
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)``, the component being the least node of it, for
    every node of ``edges`` (whole numbers; loops, repeated and null edges are
    ignored)."""
    current = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                     .filter((F.col("u") > F.col("v")) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        current = stored(_star(_star(current, True), False))
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
