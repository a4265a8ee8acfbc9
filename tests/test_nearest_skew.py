"""Nearest sites through the cell tree, and joins with unknown frequent keys,
against brute force with a third of all rows in one spot."""

import math
import random

import pytest
from pyspark.sql import functions as F

from valora.operators import ranking, skew
from valora.operators.cells import LEAF, site_tree
from valora.operators.nearest import nearest_site
from valora.operators.skew import frequent_keys, of_frequent_keys, skew_join
from valora.operators.star import ADDRESS_KEY, SALE_KEY, sale_facts


def _order(v):
    return (v is None, v)


def brute(left, right):
    """id -> (site, distance) by (distance, nulls last, site)."""
    out = {}
    for i, b, x, y in left:
        cands = []
        for j, sb, sx, sy in right:
            if b is not None and sb == b:
                ok = None not in (x, y, sx, sy)
                d = (x - sx) * (x - sx) + (y - sy) * (y - sy) if ok else None
                cands.append((d is None, d or 0.0, j, d))
        if cands:
            *_, j, d = min(cands)
            best = (d is None, d or 0.0, j)
            if i not in out or best < out[i][0]:
                out[i] = (best, j, d)
    return {i: (j, d) for i, (_, j, d) in out.items()}


def rows_of(spark, left, right, how="inner"):
    L = spark.createDataFrame(left, "id int, blk string, x double, y double")
    R = spark.createDataFrame(right, "sid int, sblk string, sx double, sy double")
    got = nearest_site(L, R, ["id"], F.col("blk"), F.col("sblk"), ("x", "y"), ("sx", "sy"), "d", ["sid", "x", "y"], how)
    assert got.columns == ["id", "blk", "x", "y", "sid", "sblk", "sx", "sy", "d"]
    return got.collect()


def test_a_dense_town_and_far_places(spark):
    rnd = random.Random(3)
    right = [(j, "le", 5 + rnd.gauss(0, 1e-4), 5 + rnd.gauss(0, 1e-4)) for j in range(300)]      # a third in one town
    right += [(300 + j, "le", rnd.uniform(0, 10), rnd.uniform(0, 10)) for j in range(200)]
    right += [(500 + j, f"b{j % 6}", rnd.uniform(0, 10), 2.0) for j in range(300)]              # on one line
    right += [(800 + j, "one", 1.0, 1.0) for j in range(200)] + [(1000, "nowhere", None, None), (1001, "nowhere", None, 1.0)]
    right += [(1002, "le", None, None), (1003, None, 5.0, 5.0), (1004, "le", 7.25, 7.25), (1005, "le", 7.25, 7.25)]
    left = [(i, "le", 5 + rnd.gauss(0, 1e-4), 5 + rnd.gauss(0, 1e-4)) for i in range(300)]
    left += [(300 + i, "le", rnd.uniform(-5, 15), rnd.uniform(-5, 15)) for i in range(300)]
    left += [(600 + i, f"b{i % 8}", rnd.uniform(0, 10), rnd.uniform(0, 4)) for i in range(200)]
    left += [(800 + i, "le", 3.5, 3.5) for i in range(400)]                                     # one place, a third of all rows
    left += [(1300, "one", 2.0, 2.0), (1301, "nowhere", 1.0, 1.0), (1302, "le", None, 1.0), (1303, None, 1.0, 1.0),
             (1304, "unknown", 1.0, 1.0), (1305, "le", 7.25, 7.25), (1306, "le", 1.0, 9.0), (1306, "one", 1.0, 1.5)]
    want = brute(left, right)
    got = {r.id: (r.sid, r.d) for r in rows_of(spark, left, right)}
    assert got == want
    kept = {r.id: r.sid for r in rows_of(spark, left, right, "left")}
    assert kept[1303] is None and kept[1304] is None and {i: s for i, s in kept.items() if i in want} == {
        i: s for i, (s, _) in want.items()}


def test_ties_on_a_lattice(spark):
    right = [(10 * a + b, "k", float(a), float(b)) for a in range(10) for b in range(10)]
    left = [(i, "k", 0.5 * (i % 21), 0.5 * (i // 21)) for i in range(441)]
    assert {r.id: (r.sid, r.d) for r in rows_of(spark, left, right)} == brute(left, right)


def test_frequent_places_stay_and_others_move(spark, monkeypatch):
    """Rows at the two most frequent places don't move; the sites are those of brute force, also at other places."""
    monkeypatch.setattr(skew, "STAYING", 2)
    rnd = random.Random(7)
    right = [(j, "ab"[j % 2], rnd.uniform(0, 9), rnd.uniform(0, 9)) for j in range(90)] + [(90, "c", None, None)]
    left = [(i, "a", 1.0, 1.0) for i in range(50)] + [(50 + i, "b", -0.0, 2.0) for i in range(40)]
    left += [(90 + i, "ab"[i % 2], float(i % 5), 3.0) for i in range(20)] + [(110, "c", 1.0, 1.0), (111, "a", None, 1.0), (112, None, 1.0, 1.0)]
    assert {r.id: (r.sid, r.d) for r in rows_of(spark, left, right)} == brute(left, right)
    L = spark.createDataFrame(left, "id int, blk string, x double, y double")
    found = of_frequent_keys(L, L.where("x is not null").select("blk", "x", "y").distinct(), ["blk", "x", "y"])
    assert {(r.blk, r.x) for r in found.collect()} == {("a", 1.0), ("b", 0.0)}


def test_facts_carry_only_their_columns(spark, monkeypatch):
    """Columns that only order the facts, or that nobody asked for, are not written; ids and rows as before."""
    written, keep = [], ranking.stable
    monkeypatch.setattr(ranking, "stable", lambda df: written.append(df.columns) or keep(df))
    rows = [(10 - i, i % 3, "rue", "01", "2020-01-01", float(i), 1.0, 2, "t", "n", "1", "wide " * 50) for i in range(10)]
    sales = spark.createDataFrame(rows, "k int, adresse_numero int, adresse_nom_voie string, code_postal string, date_mutation string, "
                                  "valeur_fonciere double, surface_reelle_bati double, nombre_pieces_principales int, type_local string, "
                                  "nature_mutation string, code_departement string, note string")
    dim = spark.createDataFrame([(7, 0, "rue", "01"), (8, 1, "rue", "01")], ["id_adresse", *ADDRESS_KEY])
    out = sale_facts(sales, dim, order_cols=["k"])
    facts = ["id_adresse", "date_mutation", "valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales",
             "type_local", "nature_mutation", "code_departement"]
    assert written == [[*facts, "_pid", "_mono"]] and out.columns == ["id_mutation", *facts]
    joined = sorted((r[0], 7 + r[1], r[5]) for r in rows if r[1] < 2)
    assert sorted((r.id_mutation, r.id_adresse, r.valeur_fonciere) for r in out.collect()) == [
        (n, i, v) for n, (_, i, v) in enumerate(joined, 1)]
    by_default = sale_facts(sales, dim, how="left")
    assert by_default.columns == ["id_mutation", *facts] and by_default.where("id_adresse is null").count() == 3
    assert set(SALE_KEY).isdisjoint(by_default.columns)


def test_empty_sides(spark):
    one = [(1, "k", 1.0, 1.0)]
    assert rows_of(spark, [], one) == [] and rows_of(spark, one, []) == []
    assert [r.sid for r in rows_of(spark, one, [], "left")] == [None]


def test_leaves_are_small_and_hold_each_site_once(spark):
    rnd = random.Random(9)
    pts = {(rnd.gauss(0, 1e-3) if k % 3 else rnd.uniform(-50, 50), rnd.gauss(0, 1e-3)) for k in range(2000)}
    sites = spark.createDataFrame([("k", x, y) for x, y in pts], "block string, sx double, sy double")
    nodes, leaves = site_tree(sites, ["sx", "sy"])
    held = leaves.groupBy("node").count().collect()
    assert sum(r["count"] for r in held) == len(pts) and max(r["count"] for r in held) <= LEAF
    assert nodes.where("leaf").count() == len(held)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_same_as_join(spark, how):
    rnd = random.Random(1)
    left = [(i, 7 if i % 3 == 0 else None if i % 10 == 1 else rnd.randrange(60), "x" if i % 3 == 0 else f"t{i % 4}")
            for i in range(3000)] + [(1, 7, "x")] * 500
    right = [(k, t, f"{k}{t}") for k in range(40) for t in ("x", "t1", "t2")] + [(7, "x", "again"), (None, "t1", "never")]
    L = spark.createDataFrame(left, "id int, k int, t string")
    R = spark.createDataFrame(right, "k int, t string, v string")
    got = skew_join(L, R, ["k", "t"], how, parts=16)
    want = L.join(R, ["k", "t"], how)
    assert got.columns == want.columns
    key = lambda r: tuple(map(_order, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    hot = frequent_keys(L.where("k IS NOT NULL"), ["k", "t"], 16).collect()
    assert max(r["__parts"] for r in hot) == math.ceil(16 * 1500 / L.where("k IS NOT NULL").count())


def test_skew_join_spreads_the_hot_key(spark):
    L = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    R = spark.range(60_000).select(F.col("id").alias("k")).union(spark.sql("SELECT -1L"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        sizes = [r["count"] for r in skew_join(L, R, ["k"], parts=8).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 60_000 and max(sizes) < 60_000 / 4


def test_skew_join_null_safe(spark):
    L = spark.createDataFrame([(1, None), (2, "a"), (3, "b")] + [(9, None)] * 50, "id int, g string")
    R = spark.createDataFrame([(None, 10), ("a", 20)], "g string, v int")
    got = skew_join(L, R, ["g"], "left", null_safe=True, parts=8).collect()
    assert len(got) == 53 and {(r.id, r.v) for r in got} == {(1, 10), (2, 20), (3, None), (9, 10)}


@pytest.mark.parametrize("metric, itself", [("planar", False), ("planar", True), ("haversine", False), ("haversine", True)])
def test_proximity_in_a_dense_town(spark, metric, itself):
    """A third of all points of interest within the radius of each other, another
    part on one spot, the rest far apart."""
    from valora.functions import haversine_m
    from valora.operators.spatial import proximity

    rnd = random.Random(8)
    pois = [(j, "a", 2 + rnd.gauss(0, 2e-3), 48 + rnd.gauss(0, 2e-3)) for j in range(250)]
    pois += [(250 + j, "a", 2.001, 48.001) for j in range(150)] + [(400 + j, "b", 2.0, 48.0) for j in range(3)]
    pois += [(500 + j, "ab"[j % 2], rnd.uniform(1.9, 2.1), rnd.uniform(47.9, 48.1)) for j in range(300)]
    pois += [(900, "a", None, 48.0), (901, None, 2.0, 48.0)]
    pts = pois if itself else [(i, b, x, y) for i, b, x, y in pois[::3]] + [(2000, "a", 2.5, 48.0), (2001, "c", 2.0, 48.0)]
    radius = 0.004 if metric == "planar" else 400.0
    P = spark.createDataFrame(pts, "id int, b string, x double, y double")
    Q = spark.createDataFrame(pois, "pid int, pb string, px double, py double")
    got = {r.id: (r.n_within, r.nearest_id, r.nearest_distance) for r in proximity(
        P, Q, ["id"], "pid", "x", "y", "px", "py", radius, metric, [("b", "pb")], itself).collect()}
    d = (haversine_m(F.col("x"), F.col("y"), F.col("px"), F.col("py")) if metric == "haversine" else
         (F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("y") - F.col("py")) * (F.col("y") - F.col("py")))
    pairs = P.join(Q, P.b == Q.pb).withColumn("d", d).where(F.col("d") <= (radius if metric == "haversine" else radius * radius))
    want = {i: (0, None, None) for i, *_ in pts}
    near = {}
    for r in pairs.select("id", "pid", "d").collect():
        if not (itself and r.id == r.pid):
            near.setdefault(r.id, []).append((r.d, r.pid))
    want |= {i: (len(v), min(v)[1], min(v)[0]) for i, v in near.items()}
    assert got == want


def test_a_descent_is_cut_into_pieces(spark):
    """Places are few rows before and many after, so their number of tasks is not left to their bytes."""
    from valora.operators.cells import PIECES
    from valora.operators.spatial import proximity

    P = spark.range(500).selectExpr("id", "id * 0.7531D % 10 AS x", "id * 0.377D % 10 AS y")
    out = proximity(P, P, ["id"], "id", "x", "y", "x", "y", 1.0, exclude_same_id=True)
    plans = []

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stable(df)

    import valora.operators.spatial as spatial
    stable, spatial.stable = spatial.stable, plan
    try:
        again = proximity(P, P, ["id"], "id", "x", "y", "x", "y", 1.0, exclude_same_id=True)
    finally:
        spatial.stable = stable
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * PIECES
    above = plans[-1].split("REPARTITION_BY_NUM")[0]
    assert "hashpartitioning(piece" in above and f", {n})" in above
    assert "Exchange hashpartitioning(__x" not in above and "Exchange hashpartitioning(block" not in above
    assert sorted(out.collect()) == sorted(again.collect())
