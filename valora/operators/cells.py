"""Trees of cells over located sites, and descents through them.

The sites of a block form a tree of cells, each split by 4 along every axis
while it holds more than ``LEAF`` sites, so cells are small where sites are dense.  A
node knows the box its sites lie in, one of them, and their number.  All
locations go down together, level by level, one join a level; a descent
decides by the distances to a node's box what to do with it.

The upper nodes, which all locations of a block pass, are there once per part
of the locations; below, a node is met only by the locations near it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valora.operators.ranking import stable

#: Sites of a cell that is not split further; levels of the tree below its root.
LEAF, DEPTH = 32, 13
#: Nodes of so many upper levels are met by parts of a block's locations.
UPPER = 3
#: Pieces of locations per shuffle partition.  A location becomes many rows on its way down, which a task
#: keeps sorted, so tasks are cut by what the locations will be, not by what they are.
PIECES = 8


def _plus(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _cells(n: int) -> list[str]:
    return [f"g{i}" for i in range(n)]


def _levels(sites: DataFrame, axes: list[str]) -> DataFrame:
    """Each site once per level, with the cell it lies in there.  Cells of one
    level nest in those above: a cell is the deepest one's number without its last bits."""
    extent = sites.groupBy("block").agg(*[F.min(c).alias(f"least{i}") for i, c in enumerate(axes)], F.greatest(
        *[F.max(c) - F.min(c) for c in axes], F.lit(0.0)).alias("span"))
    most = 1 << (2 * DEPTH)
    deep = {f"d{i}": F.when(F.col("span") > 0, F.least(
        F.floor((F.col(c) - F.col(f"least{i}")) / F.col("span") * most), F.lit(most - 1))).otherwise(0).cast("long")
        for i, c in enumerate(axes)}
    placed = sites.join(extent, "block").withColumns(deep).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))))
    up = 2 * (DEPTH - F.col("level"))
    return (placed.withColumns({g: F.call_function("shiftright", F.col(f"d{i}"), up) for i, g in enumerate(_cells(len(axes)))})
            .drop("span", *deep, *[f"least{i}" for i in range(len(axes))]))


def site_tree(sites: DataFrame, axes: list[str], weight: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trees of ``sites`` (block, axes, ...), and the sites with the
    ``node`` of their leaf.  A node's ``held`` is the sum of ``weight`` (1 a site) over its sites."""
    grid = _cells(len(axes))
    spread = _levels(sites, axes)
    counts = spread.groupBy("block", "level", *grid).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.lit(1) if weight is None else weight).alias("held"),
        *[f(c).alias(f"{name}{i}") for i, c in enumerate(axes) for f, name in ((F.min, "low"), (F.max, "high"))],
        F.min(F.struct(*[F.col(c) for c in axes])).alias("one"))
    counts = counts.select("*", F.xxhash64("block", "level", *grid).alias("node"),
                           ((F.col("n") <= LEAF) | (F.col("level") == DEPTH)).alias("leaf"),
                           F.xxhash64("block", F.col("level") - 1, *[F.shiftright(g, 2) for g in grid]).alias("above"))
    parents = counts.where(~F.col("leaf")).select(F.col("node").alias("above"), F.lit(True).alias("split"))
    nodes = stable(counts.join(parents, "above", "left").where(F.col("split") | (F.col("level") == 0)).drop("split", "n", *grid))
    leaves = nodes.where("leaf").select("block", "node")
    return nodes, (spread.withColumn("node", F.xxhash64("block", "level", *grid)).drop("level", *grid)
                   .join(leaves, ["block", "node"]))


def root_of(n: int) -> Column:
    """The node above the root of a block's tree, where a descent begins."""
    return F.xxhash64("block", F.lit(-1), *[F.shiftright(F.lit(0).cast("long"), 2)] * n)


def nearest_of_box(at: list[str]) -> Column:
    """Squared distance from a location to a node's box."""
    gaps = [F.greatest(F.col(f"low{i}") - F.col(c), F.col(c) - F.col(f"high{i}"), F.lit(0.0)) for i, c in enumerate(at)]
    return _plus([g * g for g in gaps])


def farthest_of_box(at: list[str]) -> Column:
    """Squared distance from a location to the farthest corner of a node's box."""
    gaps = [F.greatest(F.col(f"high{i}") - F.col(c), F.col(c) - F.col(f"low{i}")) for i, c in enumerate(at)]
    return _plus([g * g for g in gaps])


def one_of_box(at: list[str], axes: list[str]) -> Column:
    """Squared distance from a location to the site a node knows."""
    return _plus([(F.col(c) - F.col(f"one.{a}")) * (F.col(c) - F.col(f"one.{a}")) for c, a in zip(at, axes)])


def descend(places: DataFrame, nodes: DataFrame, own: list[str], at: list[str], carried: dict[str, Column],
            computed: dict[str, Column], decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``places`` (block, key columns ``own`` and coordinates ``at``) with the ``node`` of each leaf they reach.

    ``carried`` columns start with the given values; at each level a row meets
    the nodes below its own, ``computed`` gives the columns' values from a node's (its sum of
    weights is ``kid_held``; other columns stay), and ``decide`` drops or changes rows.  Rows that are at a
    ``leaf`` meet nothing and are only passed to ``decide``.  Windows over a place partition by ``piece`` too,
    the whole number by which places are dealt out (Spark deals doubles anew for a window), and ``decide`` keeps it."""
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    depth = nodes.agg(F.max("level")).first()[0]
    kept = list(dict.fromkeys(["piece", "block", *own, *at]))
    now = places.withColumn("piece", F.xxhash64("block", *own)).repartition(parts * PIECES, "piece").withColumns({"node": root_of(len(at)), "leaf": F.lit(False), **carried})
    box = [f"{name}{i}" for i in range(len(at)) for name in ("low", "high")]
    for level in range(-1, -1 if depth is None else depth):
        copies = parts if level < UPPER else 1
        below = (nodes.where(F.col("level") == level + 1)
                 .select("block", F.col("above").alias("meet"), F.col("node").alias("kid"), F.col("leaf").alias("last"),
                         F.col("held").alias("kid_held"), "one", *box).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))
        # a leaf meets nothing, wherever its row is
        met = (now.withColumns({"meet": F.when(F.col("leaf"), F.xxhash64(*own, "node")).otherwise(F.col("node")),
                                "part": F.pmod(F.xxhash64(*own), F.lit(copies)).cast("int")})
               .join(below, ["block", "meet", "part"], "left").where(F.col("leaf") | F.col("kid").isNotNull()))
        new = F.col("kid").isNotNull()
        now = decide(met.select(
            *kept, F.coalesce("kid", "node").alias("node"), F.coalesce("last", "leaf").alias("leaf"),
            *[F.when(new, computed[c]).otherwise(F.col(c)).alias(c) if c in computed else F.col(c) for c in carried]))
    return now.where("leaf")
