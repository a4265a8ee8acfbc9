"""Points in zones through the cell cover, against the even-odd rule over all edges."""

import math
import random

from valora.operators.spatial import ACROSS, points_in_zones, zone_cover


def inside(px, py, edges):
    return sum(((y1 > py) != (y2 > py)) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in edges) % 2 == 1


def star(rnd, cx, cy, r, n):
    pts = [(cx + r * rnd.uniform(0.2, 1) * math.cos(2 * math.pi * k / n), cy + r * rnd.uniform(0.2, 1) * math.sin(2 * math.pi * k / n))
           for k in range(n)]
    return [(*a, *b) for a, b in zip(pts, pts[1:] + pts[:1])]


def test_all_sizes_and_a_town_on_a_rim(spark):
    rnd = random.Random(4)
    zones = {f"z{k}": star(rnd, rnd.uniform(-5, 5), rnd.uniform(-5, 5), 10 ** rnd.uniform(-4, 1), rnd.choice([3, 5, 40]))
             for k in range(60)}
    square = lambda a, b, r: [(a - r, b - r, a + r, b - r), (a + r, b - r, a + r, b + r),
                              (a + r, b + r, a - r, b + r), (a - r, b + r, a - r, b - r)]
    zones["hole"] = square(0.0, 0.0, 2.0) + square(0.0, 0.0, 1.0)
    zones["lattice"] = square(4.0, 4.0, 1.0)                     # its sides lie on cell borders
    zones["flat"] = [(0.0, 1.0, 1.0, 1.0)]
    zones["dot"] = [(3.0, 3.0, 3.0, 3.0)]
    pts = [(i, 1 + rnd.gauss(0, 1e-4), 1 + rnd.gauss(0, 1e-4)) for i in range(300)]        # a third, at a corner of the hole
    pts += [(300 + i, rnd.uniform(-7, 7), rnd.uniform(-7, 7)) for i in range(400)]
    pts += [(700 + i, *rnd.choice([(3.0, 3.0), (5.0, 5.0), (4.5, 3.0), (3.0, 4.25), (1.0, 1.0), (-1.0, 0.5)])) for i in range(200)]
    pts += [(900, None, 1.0), (901, 1.0, float("nan"))]
    E = spark.createDataFrame([(z, *map(float, e)) for z, es in zones.items() for e in es]
                              + [("broken", None, 0.0, 1.0, 1.0)], "zone string, x1 double, y1 double, x2 double, y2 double")
    P = spark.createDataFrame(pts, "id int, x double, y double")
    got = {(r.id, r.zone) for r in points_in_zones(P, E, ["id"], "x", "y").collect()}
    want = {(i, z) for i, x, y in pts for z, es in zones.items() if x is not None and y == y and inside(x, y, es)}
    assert got == want and len(want) > 300
    cover, _ = zone_cover(E)
    counts = {r.zone: r["count"] for r in cover.groupBy("zone").count().collect()}
    assert max(counts.values()) <= (ACROSS + 2) ** 2
    assert cover.where("inside").count() > 0


def test_no_zones_no_points(spark):
    E = spark.createDataFrame([], "zone string, x1 double, y1 double, x2 double, y2 double")
    P = spark.createDataFrame([(1, 0.0, 0.0)], "id int, x double, y double")
    assert points_in_zones(P, E, ["id"], "x", "y").count() == 0
    one = spark.createDataFrame([("z", 0.0, 0.0, 1.0, 0.0), ("z", 1.0, 0.0, 0.0, 1.0), ("z", 0.0, 1.0, 0.0, 0.0)], E.schema)
    assert points_in_zones(P.where("id > 5"), one, ["id"], "x", "y").count() == 0


def test_only_frequent_keys_are_broadcast(spark):
    """Edges and cells are many rows in small files, so none of them is held by the driver."""
    E = spark.createDataFrame([(z, *e) for z in range(40) for e in star(random.Random(z), 0.1 * z, 0.0, 2.0, 4 + 30 * (z % 2))],
                              "zone int, x1 double, y1 double, x2 double, y2 double")
    P = spark.range(200).selectExpr("id", "id * 0.03D - 3 AS x", "(id % 7) * 0.1D AS y")
    out = points_in_zones(P.union(P), E, ["id"], "x", "y")
    rows = out.collect()
    lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
    deep = [len(line) - len(line.lstrip(" :+-|*()0123456789")) for line in lines]
    for k in (k for k, line in enumerate(lines) if "BroadcastExchange" in line):
        below = next((j for j in range(k + 1, len(lines)) if deep[j] <= deep[k]), len(lines))
        assert any("approx_top_k" in line for line in lines[k:below]), "\n".join(lines[k:below])
    assert len(rows) == 2 * len(set(rows)) > 0
