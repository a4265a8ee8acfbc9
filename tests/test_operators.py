"""Operator semantics on FIXTURES-style rows."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from valora.functions import sq_planar_distance
from valora.operators.clean import AuditSpec, clean_audits, impute_median
from valora.operators.dedup import dedup_counts, latest_per_key
from valora.operators.joins import block_fanout, nearest_match
from valora.operators.profile import missing_profile, residual_nulls
from valora.operators.quality import audit_checks, check_counts, qc_report, qc_totals
from valora.operators.spatial import proximity


def test_latest_per_key_nulls_last_and_null_key(spark):
    rows = [("K1", None, 1), ("K1", dt.date(2024, 1, 1), 2), ("K1", dt.date(2025, 1, 1), 3),
            ("K2", dt.date(2024, 5, 5), 4), ("K2", dt.date(2024, 5, 5), 5), (None, dt.date(2030, 1, 1), 6),
            ("K3", None, 7)]
    df = spark.createDataFrame(rows, "k string, d date, id int")
    out = latest_per_key(df, ["k"], [F.desc_nulls_last("d"), F.desc("id")])
    assert sorted((r.k, r.id) for r in out.collect()) == [("K1", 3), ("K2", 5), ("K3", 7)]
    c = dedup_counts(df, out).collect()[0]
    assert (c.n_before, c.n_after, c.n_removed) == (7, 3, 4)   # includes the NULL-key row
    import contextlib, io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    plan = buf.getvalue()
    assert "WindowGroupLimit" in plan


def test_impute_median_and_audit_projection(spark):
    nb = "\u00a0"
    rows = [("A1", "1 234,5", " d ", "bon", "", None, "-0.1"),
            ("A2", "n/a", "H", "1.5", "  ", "Plein", "1.2"),
            ("A3", "100", None, "2", None, None, None),
            ("A4", f"1{nb}234,5", "a", None, "x", None, "0.5")]
    df = spark.createDataFrame(rows, "numero_dpe string, conso_5_usages_ep string, etiquette_dpe string, "
                                     "indicateur_confort_ete string, zone_climatique string, "
                                     "isolation_toiture string, score_ban string")
    out = {r.numero_dpe: r for r in clean_audits(df, AuditSpec()).collect()}
    # median of {1234.5, 100} = 667.25 fills 'n/a' and the no-break-space value
    assert out["A1"].conso_5_usages_ep == 1234.5 and out["A2"].conso_5_usages_ep == 667.25
    assert out["A4"].conso_5_usages_ep == 667.25
    assert out["A1"].etiquette_dpe == "D" and out["A3"].etiquette_dpe is None
    assert [out[k].indicateur_confort_ete for k in ("A1", "A2", "A3", "A4")] == [0, 2, 2, 0]
    assert out["A1"].zone_climatique == "NR" and out["A4"].zone_climatique == "x"
    assert out["A1"].isolation_toiture == "Inconnu" and out["A2"].isolation_toiture == "Plein"
    assert out["A3"].score_ban == 0.0 and out["A1"].score_ban == -0.1
    # a column with no parsable value imputes 0
    allbad = spark.createDataFrame([("x",), ("",)], "m string")
    assert [r.m for r in impute_median(allbad, ["m"]).collect()] == [0.0, 0.0]


def test_qc_report(spark):
    rows = [("D1", "A", "B", "2024-01-01", "2034-01-01", 50.0, 10.0, 0.5),
            ("D1", "h", "C", "2024-01-01", "2023-01-01", 0.0, -5.0, 1.2),
            (None, "B", None, None, "2020-01-01", 2001.0, 1.0, -0.1),
            ("D2", " d ", "Z", "2024-01-01", None, -1.0, 3.0, 0.9)]
    df = spark.createDataFrame(rows, "numero_dpe string, etiquette_dpe string, etiquette_ges string, "
                                     "date_etablissement_dpe string, date_fin_validite_dpe string, "
                                     "surface_habitable_logement double, conso_5_usages_ep double, score_ban double")
    rep = {r.check_name: r.n for r in qc_report(df, audit_checks(as_of="2025-01-01"), dup_key="numero_dpe").collect()}
    assert rep == {"null_numero_dpe": 1, "dup_numero_dpe": 1, "invalid_etiquette_dpe": 1, "invalid_etiquette_ges": 1,
                   "date_fin_avant_etablissement": 1, "surface_<=0": 2, "surface_>2000": 1,
                   "conso_ep_negative": 1, "score_ban_hors_range": 2}
    info = {r.check_name: r.n for r in check_counts(df, audit_checks(as_of="2025-01-01"), include_info=True).collect()}
    assert info["expired"] == 2
    t = qc_totals(qc_report(df, audit_checks(), dup_key="numero_dpe")).collect()[0]
    assert (t.total_anomalies, t.n_categories) == (11, 9)


def test_missing_profile(spark):
    df = spark.createDataFrame([("a", None), ("", 1.0), ("  ", 2.0), (None, 3.0)] * 5, "t string, x double")
    prof = {r.column_name: (r.n, r.pct, r.flag) for r in missing_profile(df).collect()}
    assert prof == {"t": (15, 75.0, "high"), "x": (5, 25.0, "high")}
    assert [(r.column_name, r.n) for r in residual_nulls(df).collect()] == [("t", 5), ("x", 5)]


def _brute_nearest(left, right):
    out = {}
    for lid, lb, lx, ly in left:
        best = None
        for rid, rb, rx, ry in right:
            if rb != lb or rx is None or ry is None:
                continue
            d = (lx - rx) * (lx - rx) + (ly - ry) * (ly - ry)
            if best is None or (d, rid) < best:
                best = (d, rid)
        if best:
            out[lid] = best[1]
    return out


def test_nearest_match_broadcast_and_salted(spark):
    rnd = random.Random(5)
    left = [(i, "le" if i % 3 == 0 else f"b{i % 7}", rnd.random(), rnd.random()) for i in range(400)]
    right = [(j, "le" if j % 2 == 0 else f"b{j % 7}", rnd.random(), rnd.random()) for j in range(60)]
    right.append((999, "le", None, None))            # station without coordinates never wins (Q1)
    exp = _brute_nearest(left, right)
    L = spark.createDataFrame(left, "id int, blk string, x double, y double")
    R = spark.createDataFrame(right, "sid int, sblk string, sx double, sy double")
    got = nearest_match(L, R, ["id"], F.col("blk"), F.col("sblk"),
                        lambda c: sq_planar_distance(c("x"), c("y"), c("sx"), c("sy")), "d", tie_break=["sid"])
    assert {r.id: r.sid for r in got.collect()} == exp
    fan = {r.block_key: r.n_pairs for r in block_fanout(L, R, F.col("blk"), F.col("sblk")).collect()}
    assert fan["le"] == sum(1 for x in left if x[1] == "le") * sum(1 for x in right if x[1] == "le")


def test_proximity_near_the_pole_and_across_the_meridian(spark):
    """Haversine cells lose no pair at any latitude or at 180 degrees."""
    rnd = random.Random(19)
    place = lambda: (rnd.choice([rnd.uniform(179.9, 180), rnd.uniform(-180, -179.9)]),
                     rnd.choice([rnd.uniform(74.9, 75.1), rnd.uniform(84.9, 85), rnd.uniform(-89.99, -89.9), 0.01]))
    pts = [(i, *place()) for i in range(150)]
    pois = [(100 + j, *place()) for j in range(150)]
    P = spark.createDataFrame(pts, "id int, lon double, lat double")
    Q = spark.createDataFrame(pois, "pid int, plon double, plat double")
    got = {r.id: (r.n_within, r.nearest_id) for r in proximity(
        P, Q, ["id"], "pid", "lon", "lat", "plon", "plat", radius=5000.0, metric="haversine").collect()}

    def hav(a, b, c, d):
        p, q = math.radians(b), math.radians(d)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(c - a) / 2) ** 2
        return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(h)))

    found = 0
    for i, x, y in pts:
        near = sorted((hav(x, y, a, b), p) for p, a, b in pois if hav(x, y, a, b) <= 5000.0)
        found += len(near)
        assert got[i] == (len(near), near[0][1] if near else None)
    assert found > 100


def test_proximity_matches_brute_force(spark):
    rnd = random.Random(9)
    pts = [(i, rnd.uniform(2.0, 2.6), rnd.uniform(48.6, 49.0)) for i in range(150)]
    pois = [(100 + j, rnd.uniform(2.0, 2.6), rnd.uniform(48.6, 49.0)) for j in range(80)]
    P = spark.createDataFrame(pts, "id int, lon double, lat double")
    Q = spark.createDataFrame(pois, "pid int, plon double, plat double")
    got = {r.id: (r.n_within, r.nearest_id) for r in proximity(
        P, Q, ["id"], "pid", "lon", "lat", "plon", "plat", radius=3000.0, metric="haversine").collect()}

    def hav(a, b, c, d):
        p1, p2 = math.radians(b), math.radians(d)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(c - a) / 2) ** 2
        return 2 * 6371008.8 * math.asin(min(1.0, math.sqrt(h)))
    for i, x, y in pts:
        ds = sorted((hav(x, y, qx, qy), qid) for qid, qx, qy in pois if hav(x, y, qx, qy) <= 3000.0)
        assert got[i][0] == len(ds)
        assert got[i][1] == (ds[0][1] if ds else None)


def test_equal_distance_stations_tie_break(spark):
    from valora.operators.star import address_dimension
    adr = spark.createDataFrame([(1, "rue A", "72000", "Le Mans", 0.0, 0.0, "72181")],
                                "numero long, nom_voie string, code_postal string, nom_commune string, "
                                "lon double, lat double, code_insee string")
    st = spark.createDataFrame([("Zeta", "Le Mans", 1.0, 0.0), ("Alpha", "Le Mans", -1.0, 0.0),
                                ("NoGeo", "Le Mans", None, None)],
                               "libelle string, commune string, longitude double, latitude double")
    row = address_dimension(adr, st).collect()[0]
    # equal squared distance 1.0: the tie goes to the first station name;
    # the station without coordinates never wins
    assert row.nom_gare_proche == "Alpha" and row.distance_gare_degres == 1.0


def test_blank_audit_key_dropped(spark):
    from valora.plans.build import dedup_audits
    df = spark.createDataFrame([("", "2024-01-01"), (None, "2024-01-02"), ("K", "2024-01-03")],
                               "numero_dpe string, date_derniere_modification_dpe string")
    cleaned = clean_audits(df, AuditSpec())
    assert [r.numero_dpe for r in dedup_audits(cleaned).collect()] == ["K"]


import pytest  # noqa: E402


def test_proximity_self_mode_with_hot_location(spark):
    rnd = random.Random(11)
    pts = [(i, 0.5, 0.5) for i in range(40)]                       # a hot spot: 40 rows, one location
    pts += [(100 + i, rnd.uniform(0, 1), rnd.uniform(0, 1)) for i in range(120)]
    pts += [(500, None, 0.3)]
    P = spark.createDataFrame(pts, "id int, x double, y double")
    got = {r.id: (r.n_within, r.nearest_id, r.nearest_distance) for r in proximity(
        P, P, ["id"], "id", "x", "y", "x", "y", radius=0.08, exclude_same_id=True).collect()}
    r2 = 0.08 * 0.08
    for i, px, py in pts:
        if px is None:
            assert got[i] == (0, None, None)
            continue
        ds = sorted(((px - qx) ** 2 + (py - qy) ** 2, j) for j, qx, qy in pts
                    if qx is not None and j != i and (px - qx) ** 2 + (py - qy) ** 2 <= r2)
        assert got[i][0] == len(ds), i
        assert (got[i][1], got[i][2]) == ((ds[0][1], ds[0][0]) if ds else (None, None)), i


def test_parse_failures(spark):
    from valora.operators.quality import parse_failures
    df = spark.createDataFrame([("1 234,5", "bon"), ("n/a", "2"), ("", None), ("12f", "1.5")],
                               "conso_5_usages_ep string, indicateur_confort_ete string")
    got = {r.check_name: r.n for r in parse_failures(df, ["conso_5_usages_ep"], ["indicateur_confort_ete"]).collect()}
    assert got == {"unparsable_conso_5_usages_ep": 2, "unparsable_indicateur_confort_ete": 1}


def test_dimension_metres_and_filtered_statistics(spark):
    from valora.operators.market import price_statistics
    from valora.operators.star import address_dimension
    adr = spark.createDataFrame([(1, "rue A", "72000", "Le Mans", 0.19, 48.0, "72181")],
                                "numero long, nom_voie string, code_postal string, nom_commune string, "
                                "lon double, lat double, code_insee string")
    st = spark.createDataFrame([("Le Mans", "Le Mans", 0.19, 47.99)],
                               "libelle string, commune string, longitude double, latitude double")
    row = address_dimension(adr, st, with_metres=True).collect()[0]
    assert abs(row.distance_gare_m - 1111.95) < 1.0
    sales = spark.createDataFrame([("72", "Vente", 100.0), ("72", "Vente", 300.0), ("72", "Echange", 1e9)],
                                  "dep string, nature string, price double")
    st2 = price_statistics(sales, ["dep"], "price", rollup=False, where=F.col("nature") == "Vente").collect()
    assert [(r.dep, r.median_price, r.n_sales) for r in st2] == [("72", 200.0, 2)]


def test_first_zone_most_severe(spark):
    from valora.operators.spatial import first_zone
    pts = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    inside = spark.createDataFrame([(1, "C"), (1, "A"), (2, "D")], "id int, zone string")
    got = {r.id: r.zone for r in first_zone(pts, inside, ["id"], ["A", "B", "C", "D"]).collect()}
    assert got == {1: "A", 2: "D", 3: None}


def test_geocode_fill_takes_the_point_as_a_whole(spark):
    from valora.operators.market import geocode_fill
    sales = spark.createDataFrame(
        [(1, "a", 1.0, 2.0), (2, "a", 1.0, None), (3, "a", None, 2.0), (4, "a", None, None), (5, "b", 1.0, None),
         (6, "z", None, None), (7, None, None, 2.0)], "id int, k string, lon double, lat double")
    ref = spark.createDataFrame([("a", 8.0, 9.0), ("b", 8.0, None)], "rk string, x double, y double")
    out = geocode_fill(sales, ref, [F.col("k")], [F.col("rk")], {"lon": "x", "lat": "y"}, [F.desc("__ref_lon")])
    assert {r["id"]: (r["lon"], r["lat"], r["coord_source"]) for r in out.collect()} == {
        1: (1.0, 2.0, "own"), 2: (8.0, 9.0, "reference"), 3: (8.0, 9.0, "reference"), 4: (8.0, 9.0, "reference"),
        5: (1.0, None, None), 6: (None, None, None), 7: (None, 2.0, None)}
