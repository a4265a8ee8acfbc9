"""Nearest site of the same block, without comparing all of them  (J4, W2, C11).

Locations go down the tree of a block's sites (``cells``): a node's sites are
no nearer than its box and one is as near as the site the node knows, so a
location drops the nodes whose box is farther than the nearest site it knows
(never one that ties).  Only the sites of the leaves that remain are measured.

Work is done once per distinct location; a site on top of others of its block
counts once, the first by the tie-break.  Frequent leaves and locations are
found by a sketch (``skew_join``); rows at the most frequent locations get their site by a broadcast
of a bounded number of them and don't move, all others are shuffled to theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.functions import sq_planar_distance
from valora.operators.cells import descend, nearest_of_box, one_of_box, site_tree
from valora.operators.ranking import stable
from valora.operators.skew import of_frequent_keys, skew_join


def _located(x: str, y: str) -> Column:
    return F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)


def _candidates(places: DataFrame, nodes: DataFrame) -> DataFrame:
    """The leaves that can hold a place's nearest site."""
    at = ["x", "y"]
    known = F.min("upper").over(Window.partitionBy("piece", "block", *at))
    return descend(places, nodes, at, at, {"upper": F.lit(float("inf")), "lower": F.lit(0.0)},
                   {"upper": one_of_box(at, ["sx", "sy"]), "lower": nearest_of_box(at)},
                   lambda now: now.withColumn("known", known).where(F.col("lower") <= F.col("known")).drop("known")
                   ).select("block", *at, "node")


def nearest_site(left: DataFrame, right: DataFrame, left_key_cols: list[str], left_block: Column, right_block: Column,
                 left_xy: tuple[str, str], right_xy: tuple[str, str], distance_alias: str,
                 tie_break: list[str] | None = None, how: str = "inner") -> DataFrame:
    """For every left key, the right row of the same block with the smallest
    squared planar distance: the result of ``nearest_match`` with that distance, found through a
    tree of cells.

    ``tie_break`` names columns of either side; the order is (distance, NULLs
    last), then ``tie_break``.  A row without coordinates (null or NaN) has no
    distance and never beats one that has; where no candidate has one, the tie-break alone
    decides.  ``how='left'`` keeps keys whose block has no right row.  Column names of the two sides differ."""
    ties = list(tie_break or [])
    mine = [c for c in ties if c in right.columns]
    sites = right.select(right_block.alias("block"), F.col(right_xy[0]).cast("double").alias("sx"),
                         F.col(right_xy[1]).cast("double").alias("sy"),
                         F.struct(F.struct(*[F.col(f"`{c}`") for c in mine] or [F.lit(0)]).alias("ties"),
                                  F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("row")).alias("site"))
    sites = sites.where(F.col("block").isNotNull())
    first = F.min("site").alias("site")
    known = sites.where(_located("sx", "sy")).groupBy("block", "sx", "sy").agg(first)
    nodes, leaves = site_tree(known, ["sx", "sy"])
    rows = left.withColumns({"__block": left_block, "__x": F.col(left_xy[0]).cast("double"), "__y": F.col(left_xy[1]).cast("double")})
    places = (rows.where(F.col("__block").isNotNull() & _located("__x", "__y"))
              .select(F.col("__block").alias("block"), F.col("__x").alias("x"), F.col("__y").alias("y")).distinct())
    found = skew_join(stable(_candidates(places, nodes)), leaves, ["block", "node"])
    d = sq_planar_distance(F.col("x"), F.col("y"), F.col("sx"), F.col("sy"))
    best = found.groupBy("block", "x", "y").agg(F.min(F.struct(d.alias("d"), F.col("site"))).alias("__best"))
    place = ["__block", "__x", "__y"]
    best = stable(best.select(F.col("block").alias("__block"), F.col("x").alias("__x"), F.col("y").alias("__y"), "__best"))
    anyone = sites.groupBy(F.col("block").alias("__block")).agg(F.min("site").alias("__any"))
    frequent = F.broadcast(stable(of_frequent_keys(rows.where(_located("__x", "__y")), best, place)))
    near = rows.join(frequent, place).withColumn("__any", F.lit(None).cast(anyone.schema["__any"].dataType))
    far = skew_join(rows.join(frequent.select(*place), place, "left_anti"), best, place, "left").join(anyone, "__block", how)
    out = near.unionByName(far)
    site = F.coalesce("__best.site", "__any")
    out = out.select(*[F.col(f"`{c}`") for c in left.columns], *[site["row"][c].alias(c) for c in right.columns],
                     F.col("__best.d").alias(distance_alias))
    w = Window.partitionBy(*left_key_cols).orderBy(F.col(distance_alias).asc_nulls_last(), *[F.col(t) for t in ties])
    return out.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") == 1).drop("__rank")
