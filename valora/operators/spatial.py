"""Spatial joins as relational Spark jobs (D1 noise-zone exposure, D2
proximity to stations / schools, G1 geometry validity).

Spark 4.1 has no polygon predicates, so both joins use a grid:

* point-in-polygon: every zone is covered by square cells of a size that fits
  it; points meet cells by an equality join, and only in cells with an edge
  the even-odd rule counts the edges a ray towards +x crosses.  Holes and
  multi-part zones fall out of the parity rule.
* proximity: points of interest form a tree of cells, small where they are
  dense; cells wholly within the radius of a point are counted without
  pairing, only those on its rim are entered.

Both keep work away from places where very many points lie: there cells are
inside a zone or a radius as a whole.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.functions import haversine_m, sq_planar_distance
from valora.functions.geo import EARTH_RADIUS_M
from valora.operators.cells import descend, farthest_of_box, nearest_of_box, one_of_box, site_tree
from valora.operators.ranking import stable
from valora.operators.sizing import attach_one_row, default_parallelism
from valora.operators.skew import skew_join

# Geometry types a zone file may carry and the JSON shape of
# their coordinates.
POLYGON_TYPES = {
    "Polygon": "array<array<array<double>>>",
    "MultiPolygon": "array<array<array<array<double>>>>",
}


def parse_rings(geometry: Column) -> Column:
    """Rings (array of array<array<double>> vertex lists) of a GeoJSON
    geometry ``struct<type, coordinates: JSON text>``; NULL when the type is
    unknown or the coordinates do not parse under that type's shape."""
    gtype = geometry.getField("type")
    coords = geometry.getField("coordinates")
    poly = F.from_json(coords, POLYGON_TYPES["Polygon"])
    multi = F.from_json(coords, POLYGON_TYPES["MultiPolygon"])
    return (F.when(gtype == "Polygon", poly)
            .when(gtype == "MultiPolygon", F.flatten(multi)))


def valid_ring(r: Column) -> Column:
    """A ring needs at least 4 vertices (closed triangle) of 2+ numbers."""
    return (F.size(r) >= 4) & F.forall(r, lambda p: (F.size(p) >= 2) & p[0].isNotNull() & p[1].isNotNull())


def geometry_is_valid(geometry: Column) -> Column:
    """Known polygon type whose coordinates parse and whose rings are all
    usable  (G1).  NULL geometry -> NULL (callers decide, SURVEY Q9)."""
    rings = parse_rings(geometry)
    return F.when(geometry.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(rings.isNotNull() & (F.size(rings) > 0) & F.forall(rings, valid_ring), F.lit(False)))


def zone_edges(zones: DataFrame, zone_col: str, geometry_col: str = "geometry") -> DataFrame:
    """(zone, x1, y1, x2, y2): one row per polygon edge of every valid zone."""
    rings = zones.where(geometry_is_valid(F.col(geometry_col)))
    rings = rings.select(F.col(zone_col).alias("zone"),
                         F.explode(parse_rings(F.col(geometry_col))).alias("ring"))
    return edges_from_rings(rings, "zone", "ring")


def edges_from_rings(rings: DataFrame, zone_col: str, ring_col: str) -> DataFrame:
    """Consecutive vertex pairs of each ring as edges."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(ring_col) - 2),
                        lambda i: F.struct(F.element_at(F.col(ring_col), i + 1).alias("a"),
                                           F.element_at(F.col(ring_col), i + 2).alias("b")))
    e = rings.select(F.col(zone_col).alias("zone"), F.explode(pairs).alias("e"))
    return e.select("zone", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
                    F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))


#: A zone's box is about so many cells wide or high, whichever is longer.
ACROSS = 16
#: Edges of a zone in a row of cells that its cells have with them.
INLINE = 4


def zone_cover(edges: DataFrame, zone_col: str = "zone") -> tuple[DataFrame, DataFrame]:
    """``(zone, level, cx, cy, inside)``: the cells of each zone that hold a part of it, and
    its edges by row of cells.  A cell with no edge lies wholly inside or outside, which its
    centre tells; the outside ones are left out, those with an edge have ``inside`` false.

    Cells are squares of 2**level units, their level by the size of the
    zone's box: at most ``(ACROSS + 2)**2`` cells a zone, large or small.  A zone's few numbers become
    hundreds of rows, so zones are dealt out before, and no side of a join is broadcast by the size
    Spark expects of it."""
    parts = default_parallelism(edges)
    e = edges.select(F.col(zone_col).alias("zone"), "x1", "y1", "x2", "y2").where(
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in ("x1", "y1", "x2", "y2")]))
    e = stable(e.repartition(parts))
    ends = lambda f, g, c: g(f(f"{c}1"), f(f"{c}2"))
    box = e.groupBy("zone").agg(ends(F.min, F.least, "x").alias("bx0"), ends(F.max, F.greatest, "x").alias("bx1"),
                                ends(F.min, F.least, "y").alias("by0"), ends(F.max, F.greatest, "y").alias("by1"))
    extent = F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0"))
    box = box.withColumn("level", F.when(extent > 0, F.ceil(F.log2(extent / ACROSS))).otherwise(-40).cast("int"))
    box = stable(box.repartition(parts, "zone"))
    side = F.pow(F.lit(2.0), F.col("level"))
    at = lambda c: F.floor(c / side).cast("long")
    cells = (box.withColumn("cx", F.explode(F.sequence(at(F.col("bx0")), at(F.col("bx1")))))
             .withColumn("cy", F.explode(F.sequence(at(F.col("by0")), at(F.col("by1"))))).select("zone", "level", "cx", "cy"))
    rows = e.join(box.select("zone", "level").hint("merge"), "zone").withColumn("cy", F.explode(F.sequence(
        at(F.least("y1", "y2")), at(F.greatest("y1", "y2")))))
    rim = (rows.withColumn("cx", F.explode(F.sequence(at(F.least("x1", "x2")), at(F.greatest("x1", "x2")))))
           .select("zone", "cx", "cy").distinct().withColumn("rim", F.lit(True)))
    rows = rows.where(F.col("y1") != F.col("y2"))
    cells = cells.join(rim.hint("merge"), ["zone", "cx", "cy"], "left")
    plain = cells.where(F.col("rim").isNull()).join(rows.drop("level").hint("merge"), ["zone", "cy"])
    middle = [(F.col(c) + 0.5) * side for c in ("cx", "cy")]
    inside = (plain.where(_crosses(*middle)).groupBy("zone", "level", "cx", "cy").agg(F.count(F.lit(1)).alias("k"))
              .where(F.col("k") % 2 == 1).select("zone", "level", "cx", "cy", F.lit(True).alias("inside")))
    on_rim = cells.where("rim").select("zone", "level", "cx", "cy", F.lit(False).alias("inside"))
    return inside.unionByName(on_rim), rows


def _crosses(px: Column, py: Column, of: str = "") -> Column:
    """Whether a ray from the point towards +x crosses the edge in the columns x1 to y2, with ``of`` at the end of their names."""
    x1, y1, x2, y2 = [F.col(f"{c}{of}") for c in ("x1", "y1", "x2", "y2")]
    return ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)


def points_in_zones(points: DataFrame, edges: DataFrame, id_cols: list[str], x: str, y: str) -> DataFrame:
    """(id..., zone) for every point strictly inside a zone  (D1).

    Points meet the cells that cover the zones (``zone_cover``): in a cell that
    lies wholly inside a zone nothing more is looked at; in one with an edge
    the point's ray meets the zone's edges of the same row of cells, of which it crosses
    an odd number if it is inside.  Where such a row has at most ``INLINE`` edges, they are
    there with the cell, so its points are decided where they meet it and no pair of a point and a
    zone moves again.  In longer rows every distinct location is cast against the edges once.  Cells
    and zones where very many points lie are found by a sketch and spread; nothing is broadcast by the
    size of its file, which says little about its rows.  Points without coordinates are in no zone."""
    cover, rows = zone_cover(edges)
    rows = stable(rows)
    ends = ["x1", "y1", "x2", "y2"]
    short = (rows.groupBy("zone", "cy").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= INLINE)
             .select("zone", "cy", F.lit(True).alias("short")))
    rows = rows.join(short.hint("merge"), ["zone", "cy"], "left")
    lists = rows.where("short").groupBy("zone", "cy").agg(F.collect_list(F.struct(*ends)).alias("edges"))
    # as plain columns: an array's elements make the join's code too long to be compiled
    beside = [f"{c}_{i}" for i in range(INLINE) for c in ends]
    lists = lists.select("zone", "cy", F.lit(True).alias("short"), *[
        F.get("edges", F.lit(i)).getField(c).alias(f"{c}_{i}") for i in range(INLINE) for c in ends])
    cover = stable(cover.where("inside").unionByName(cover.where("NOT inside").join(lists.hint("merge"), ["zone", "cy"], "left"),
                                                     allowMissingColumns=True))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    p = (points.select(*id_cols, px.alias("__px"), py.alias("__py"))
         .where(F.col("__px").isNotNull() & F.col("__py").isNotNull() & ~F.isnan("__px") & ~F.isnan("__py")))
    levels = cover.agg(F.collect_set("level").alias("__levels"))  # one for each power of two among the zones' sizes
    side = F.pow(F.lit(2.0), F.col("level"))

    def celled(loc: DataFrame) -> DataFrame:
        return (attach_one_row(loc, levels).withColumn("level", F.explode("__levels")).drop("__levels")
                .withColumns({c: F.floor(F.col(q) / side).cast("long") for c, q in (("cx", "__px"), ("cy", "__py"))}))

    cell = ["level", "cx", "cy"]
    crossed = reduce(lambda a, b: a + b, [F.when(_crosses(F.col("__px"), F.col("__py"), f"_{i}"), 1).otherwise(0)
                                          for i in range(INLINE)])
    here = skew_join(celled(p), cover.where("inside OR short").drop("short"), cell, merge=True)
    here = here.where(F.col("inside") | (crossed % 2 == 1)).select(*id_cols, "zone")
    long_cells = cover.where("NOT inside AND short IS NULL").drop("inside", "short", *beside)
    met = stable(skew_join(celled(p.select("__px", "__py").distinct()), long_cells, cell, merge=True).select("__px", "__py", "zone", "cy"))
    cast = skew_join(met, rows.where("short IS NULL").select("zone", "cy", *ends), ["zone", "cy"], merge=True)
    odd = (cast.where(_crosses(F.col("__px"), F.col("__py"))).groupBy("__px", "__py", "zone").agg(F.count(F.lit(1)).alias("__k"))
           .where(F.col("__k") % 2 == 1).drop("__k"))
    return here.unionByName(skew_join(p, odd, ["__px", "__py"], merge=True).select(*id_cols, "zone"))


def first_zone(points: DataFrame, inside: DataFrame, id_cols: list[str], zone_order: list[str],
               alias: str = "zone") -> DataFrame:
    """Each point with its most severe containing zone (first in
    ``zone_order``), NULL when outside every zone."""
    rank = F.array_position(F.array(*[F.lit(z) for z in zone_order]), F.col("zone"))
    best = (inside.withColumn("__r", rank).groupBy(*id_cols).agg(F.min("__r").alias("__r"))
            .withColumn(alias, F.element_at(F.array(*[F.lit(z) for z in zone_order]), F.col("__r").cast("int")))
            .drop("__r"))
    return points.join(best, id_cols, "left")


def proximity(points: DataFrame, pois: DataFrame, point_id: list[str], poi_id: str,
              x: str, y: str, poi_x: str, poi_y: str, radius: float, metric: str = "planar",
              block: list[tuple[str, str]] | None = None, exclude_same_id: bool = False,
              count_alias: str = "n_within", nearest_alias: str = "nearest_id",
              distance_alias: str = "nearest_distance") -> DataFrame:
    """For each point: how many POIs lie within ``radius`` and which is the
    nearest of them (ties -> smallest id), NULL/0 when none  (D2).

    ``metric='planar'`` uses squared input units (``radius`` in the same
    units, compared squared); ``'haversine'`` takes lon/lat degrees and a
    radius in metres, and looks in space around the unit
    sphere, so latitude and the 180th meridian make no difference.  ``block`` adds equality columns (point col, poi col),
    e.g. a label or department.  ``exclude_same_id`` is the
    self-join mode (points and POIs are the same rows): a point does not
    count or find itself.

    Rows sharing exact coordinates (default geocodes, sentinel points: the
    usual hot spot of location data) are collapsed first: POIs to one row
    per location with their count and two smallest ids (a row_number <= 2
    planned as partial + final WindowGroupLimit), points to distinct
    locations.  Only distinct locations are paired, so a location held by a
    third of all rows is one row in the spatial join; results are joined
    back to the points by location."""
    block = block or []
    bcols = [pc for pc, _ in block]
    loc = [*bcols, "__qx", "__qy"]

    q = pois.select(F.col(poi_id).alias("__pid"), *[F.col(qc).alias(pc) for pc, qc in block],
                    F.col(poi_x).cast("double").alias("__qx"), F.col(poi_y).cast("double").alias("__qy"))
    q = q.where(F.col("__qx").isNotNull() & F.col("__qy").isNotNull())
    counts = q.groupBy(*loc).agg(F.count(F.lit(1)).alias("__qn"))
    first2 = (q.withColumn("__r", F.row_number().over(Window.partitionBy(*loc).orderBy("__pid")))
              .where(F.col("__r") <= 2)
              .groupBy(*loc).agg(F.min(F.when(F.col("__r") == 1, F.col("__pid"))).alias("__id1"),
                                 F.min(F.when(F.col("__r") == 2, F.col("__pid"))).alias("__id2")))
    qloc = counts.join(first2, loc)
    ploc = (points.select(*bcols, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
            .where(F.col("__x").isNotNull() & F.col("__y").isNotNull()).distinct())
    counted, near = _within(ploc, qloc, bcols, radius, metric, 2 if exclude_same_id else 1)
    ploc_key = [*bcols, "__x", "__y"]
    # the nearest location with its two smallest ids; in self-join mode the point's own row may be the
    # nearest, and the second best is the next id there or the next location
    if not exclude_same_id:
        best = near.groupBy(*ploc_key).agg(F.min(F.struct(F.col("__d").alias("d"), F.col("__id1").alias("id"))).alias("__c1"))
    else:
        one, two = [F.struct(F.col("__d").alias("d"), F.col(i).alias("id")) for i in ("__id1", "__id2")]
        cand = near.select(*ploc_key, F.explode(F.when(F.col("__id2").isNull(), F.array(one)).otherwise(F.array(one, two))).alias("__c"))
        w = Window.partitionBy(*ploc_key).orderBy("__c")
        best = (cand.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= 2).groupBy(*ploc_key)
                .agg(*[F.min(F.when(F.col("__r") == k, F.col("__c"))).alias(f"__c{k}") for k in (1, 2)]))
    # blocks are not null here, so an equality join is enough
    res = counted.join(best.hint("merge"), ploc_key, "left")

    pts = points.withColumn("__x", F.col(x).cast("double")).withColumn("__y", F.col(y).cast("double"))
    out = skew_join(pts, res, ploc_key, "left")
    if exclude_same_id:
        own = F.col(point_id[0])
        best = F.when(F.col("__c1.id") == own, F.col("__c2")).otherwise(F.col("__c1"))
        n = F.col("__n") - F.lit(1)
    else:
        best = F.col("__c1")
        n = F.col("__n")
    out = (out.withColumn(count_alias, F.coalesce(n, F.lit(0)).cast("long"))
           .withColumn(nearest_alias, best.getField("id"))
           .withColumn(distance_alias, best.getField("d")))
    return out.drop("__x", "__y", "__n", "__c1", "__c2")


#: Relative width of the rim in which a box counts neither as inside nor as outside.
RIM = 1e-9


def _axes(metric: str, lon: Column, lat: Column) -> list[Column]:
    """Coordinates in which nearness is straight: the plane's, or those of space around
    the unit sphere, so that neither a pole nor the 180th meridian makes a difference."""
    if metric != "haversine":
        return [lon, lat]
    a, b = F.radians(lon), F.radians(lat)
    return [F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)]


def _within(places: DataFrame, sites: DataFrame, block: list[str], radius: float, metric: str,
            wanted: int) -> tuple[DataFrame, DataFrame]:
    """``places`` with the weight ``__n`` of the sites within ``radius``, and with each site there that can be among the
    ``wanted`` nearest, with its distance ``__d``.

    Cells wholly inside the radius are counted without looking at their sites, and
    entered only as long as they can hold one of the nearest; cells outside are dropped; those on
    the rim are entered.  Sites of the rim are counted by a sum of numbers, which Spark hashes; only those no farther
    than the nearest known by the descent are compared as rows, which it sorts."""
    n = 3 if metric == "haversine" else 2
    straight = 2 * math.sin(min(radius / (2 * EARTH_RADIUS_M), math.pi / 2)) if metric == "haversine" else float(radius)
    reach = straight * straight
    slack = RIM * reach + (4e-15 * straight if metric == "haversine" else 0.0)
    at, axes = [f"__a{i}" for i in range(n)], [f"__s{i}" for i in range(n)]
    key = F.struct(*[F.col(c) for c in block]) if block else F.lit(0)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in block], F.lit(True))
    sites = sites.where(present).withColumns({"block": key, **dict(zip(axes, _axes(metric, F.col("__qx"), F.col("__qy"))))})
    places = places.where(present).withColumns({"block": key, **dict(zip(at, _axes(metric, F.col("__x"), F.col("__y"))))})
    nodes, leaves = site_tree(sites.drop(*block), axes, F.col("__qn"))

    one, far, endless = one_of_box(at, axes), farthest_of_box(at), F.lit(float("inf"))
    # one site of a node is as near as ``first``, and where it holds several, the others as ``rest``
    computed = {"lower": nearest_of_box(at), "far": far, "held": F.col("kid_held"), "first": one,
                "rest": F.when(F.col("kid_held") > 1, far).otherwise(endless)}
    same = ["block", "__x", "__y"]
    of = Window.partitionBy("piece", *same)
    if wanted == 1:
        known = F.coalesce(F.min("first").over(of), endless)
    else:
        known = F.least(F.coalesce(F.try_element_at(F.sort_array(F.collect_list("first").over(of)), F.lit(wanted)), endless),
                        F.coalesce(F.min("rest").over(of), endless))

    def decide(now: DataFrame) -> DataFrame:
        # what is beyond the radius is dropped before rows of a place are brought together
        now = now.where(F.col("lower") <= reach + slack).withColumn("known", known)
        inside = F.col("counted") | (F.col("far") <= reach - slack)
        near = F.col("lower") <= F.col("known") + slack
        whole = F.struct(F.lit(True).alias("done"), F.lit(True).alias("counted"))
        go_on = F.struct(F.lit(False).alias("done"), inside.alias("counted"))
        bound = lambda c: F.when(~F.col("next.done"), F.col(c)).alias(c)
        return (now.withColumn("next", F.explode(F.array_compact(F.array(
            F.when(F.col("done") | (inside & ~F.col("counted")), whole), F.when(~F.col("done") & (near | ~inside), go_on)))))
            .select("piece", *same, *at, "node", F.when(F.col("next.done"), True).otherwise(F.col("leaf")).alias("leaf"), "held", "lower", "far",
                    bound("first"), bound("rest"), "known", "next.done", "next.counted"))

    start = {"held": F.lit(0).cast("long"), "lower": F.lit(0.0), "far": endless, "first": F.lit(None).cast("double"),
             "rest": F.lit(None).cast("double"), "known": endless, "done": F.lit(False), "counted": F.lit(False)}
    reached = stable(descend(places.select(*same, *at), nodes, ["__x", "__y"], at, start, computed, decide)
                     .select(*same, "node", "held", "lower", "known", "done", "counted"))
    if metric == "haversine":
        d, most = haversine_m(F.col("__x"), F.col("__y"), F.col("__qx"), F.col("__qy")), float(radius)
    else:
        d, most = sq_planar_distance(F.col("__x"), F.col("__y"), F.col("__qx"), F.col("__qy")), reach
    of_block = [F.col("block")[c].alias(c) for c in block]
    rim = skew_join(reached.where("NOT done AND NOT counted").select(*same, "node"),
                    leaves.select("block", "node", "__qn", "__qx", "__qy"), ["block", "node"])
    counted = (rim.where(d <= most).select(*same, "__qn")
               .unionByName(reached.where("done").select(*same, F.col("held").alias("__qn")))
               .groupBy(*same).agg(F.sum("__qn").alias("__n")).select(*of_block, "__x", "__y", "__n"))
    close = skew_join(reached.where(~F.col("done") & (F.col("lower") <= F.col("known") + slack)).select(*same, "node", "known"),
                      leaves.select("block", "node", "__id1", "__id2", "__qx", "__qy", *axes), ["block", "node"])
    gap = reduce(lambda a, b: a + b, [(p - F.col(q)) * (p - F.col(q)) for p, q in zip(_axes(metric, F.col("__x"), F.col("__y")), axes)])
    close = close.where(gap <= F.col("known") + slack).withColumn("__d", d).where(F.col("__d") <= most)
    return counted, close.select(*of_block, "__x", "__y", "__id1", "__id2", "__d")
