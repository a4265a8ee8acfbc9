"""End-to-end builds on landed fixture files."""

import json
import os

from valora import schemas
from valora.plans import audit_api, build
from valora.plans.exploration import explore_audits


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _audit_csv(rows):
    cols = schemas.AUDIT_COLUMNS
    out = [",".join(f'"{c}"' for c in cols)]
    for r in rows:
        out.append(",".join(f'"{r.get(c, "")}"' for c in cols))
    return "\n".join(out) + "\n"


def test_full_build(spark, tmp):
    hdr = ",".join(c for c, _ in schemas.SALES_COLUMNS)
    sales = [
        "2024-03-01,250000,80,12,,,rue Haute,4,Appartement,Vente,0.20,48.00,72181,72000,Le Mans,72",
        "2024-04-01,260000,81,12,,,rue Haute,4,Appartement,Vente,0.20,48.00,72181,72000,Le Mans,72",
        "2025-01-02,150000,60,3,,,quai Sud,3,Maison,Vente,0.11,49.49,76351,76600,Le Havre,76",
        "2025-02-02,90000,40,7,,,rue Nord,2,Maison,Vente,-2.2,47.27,44184,44600,Saint-Nazaire,44",
        "2023-02-02,90000,40,7,,,rue Nord,2,Maison,Vente,-2.2,47.27,44184,44600,Saint-Nazaire,44",
    ]
    _w(f"{tmp}/in/dvf.csv", hdr + "\n" + "\n".join(sales) + "\n")
    st = [{"code_uic": "1", "libelle": "Le Mans", "commune": "Le Mans", "departemen": "72",
           "c_geo": {"lon": 0.19, "lat": 47.99}},
          {"code_uic": "2", "libelle": "Le Havre", "commune": "Le Havre", "departemen": "76",
           "c_geo": {"lon": 0.12, "lat": 49.49}},
          {"code_uic": "3", "libelle": "St Nazaire", "commune": "Saint Nazaire", "departemen": "44",
           "c_geo": {"lon": -2.21, "lat": 47.28}}]
    _w(f"{tmp}/in/gares/p0.json", json.dumps({"results": st}))
    audits = [{"numero_dpe": "X1", "date_derniere_modification_dpe": "2024-01-01", "etiquette_dpe": "c",
               "conso_5_usages_ep": "120,5", "surface_habitable_logement": "50"},
              {"numero_dpe": "X1", "date_derniere_modification_dpe": "2024-06-01", "etiquette_dpe": " b ",
               "conso_5_usages_ep": "", "surface_habitable_logement": "70"},
              {"numero_dpe": "X2", "date_derniere_modification_dpe": "", "etiquette_dpe": "E",
               "conso_5_usages_ep": "200", "surface_habitable_logement": "n/a"}]
    _w(f"{tmp}/in/dpe.csv", _audit_csv(audits))
    out = build.run(spark, build.Landing(sales=f"{tmp}/in/dvf.csv", stations=f"{tmp}/in/gares",
                                         audits=f"{tmp}/in/dpe.csv"), f"{tmp}/out")
    assert set(out) == {"dvf", "dvf_rejected", "dvf_missing_columns", "gares", "dpe_final", "dpe_missing_columns", "dim_adresses", "fact_dvf",
                        "ventes", "prix", "verdicts"}
    dim = {(r.numero, r.nom_voie): r for r in spark.read.parquet(out["dim_adresses"]).collect()}
    # 'le' blocks both Le Mans and Le Havre stations: nearest wins (Q4)
    assert dim[(12, "rue Haute")].nom_gare_proche == "Le Mans"
    assert dim[(3, "quai Sud")].nom_gare_proche == "Le Havre"
    assert (7, "rue Nord") not in dim            # 'saint-nazaire' != 'saint' (Q4): dropped (Q6)
    assert sorted(r.id_adresse for r in dim.values()) == [1, 2]
    fact = spark.read.parquet(out["fact_dvf"]).collect()
    assert len(fact) == 3 and sorted(r.id_mutation for r in fact) == [1, 2, 3]
    dpe = {r.numero_dpe: r for r in spark.read.parquet(out["dpe_final"]).collect()}
    assert dpe["X1"].etiquette_dpe == "B" and dpe["X1"].conso_5_usages_ep == 160.25
    assert dpe["X2"].surface_habitable_logement == 60.0
    ex = explore_audits(spark.read.option("header", True).csv(f"{tmp}/in/dpe.csv"), as_of="2025-01-01")
    assert {r.check_name: r.n for r in ex["qc_report"].collect()} == {"dup_numero_dpe": 1}
    assert ex["dedup"].collect()[0].n_removed == 1


def test_market_tables(spark, tmp):
    """Coordinates from addresses, zone, schools and audit of each sale; prices
    and verdicts; what was left out."""
    hdr = ",".join(c for c, _ in schemas.SALES_COLUMNS)
    sales = ["2024-03-01,200000,100,12,,,rue Haute,4,Maison,Vente,0.20,48.00,72181,72000,Le Mans,72",
             "2024-04-01,100000,100,14,,,rue Haute,4,Maison,Vente,,,72181,72000,Le Mans,72",
             "2024-05-01,300000,100,,,,,4,Maison,Vente,,,72181,,Le Mans,72",
             "2024-06-01,1,0,9,,,rue Basse,4,Maison,Vente,0.5,48.5,72181,72000,Le Mans,72"]
    sales += sales[:1] * 2                       # the first sale has three parcels
    sales += ["2024-06-01,12f,0,9,,,rue Basse,4,Maison,Vente,0.5,48.5,72181,72000,Le Mans,72", "2024-06-01,1"]
    _w(f"{tmp}/m/dvf.csv", hdr + "\n" + "\n".join(sales) + "\n")
    _w(f"{tmp}/m/adr/adresses-72.csv", "numero;nom_voie;code_postal;lon;lat\n14;Rue HAUTE;72000;0.21;48.01\n"
                                       "15;Rue Haute;72000;0.3;12f\n")
    ring = lambda a: [[[0.2 - a, 48 - a], [0.2 + a, 48 - a], [0.2 + a, 48 + a], [0.2 - a, 48 + a], [0.2 - a, 48 - a]]]
    feature = lambda z, g: {"properties": {"ZONE": z, "NOM": z}, "geometry": g}
    _w(f"{tmp}/m/zones.json", json.dumps({"type": "FeatureCollection", "features": [
        feature("C", {"type": "Polygon", "coordinates": ring(0.05)}),
        feature("A", {"type": "Polygon", "coordinates": ring(0.005)}),
        feature("B", {"type": "Circle", "coordinates": []})]}))
    _w(f"{tmp}/m/schools.json", json.dumps([{"identifiant": "e1", "longitude": 0.2, "latitude": 48.001},
                                            {"identifiant": "e2", "longitude": 0.2, "latitude": 48.002},
                                            {"identifiant": "e3", "longitude": None, "latitude": 48.0}]))
    audits = [{"numero_dpe": "X1", "date_derniere_modification_dpe": "2024-01-01", "etiquette_dpe": "c",
               "adresse_brut": "12 Rue Haute", "code_insee_ban": "72181"},
              {"numero_dpe": "X2", "date_derniere_modification_dpe": "2024-06-01", "etiquette_dpe": "b",
               "adresse_brut": "12, r. Hâute 72000 LE MANS", "code_insee_ban": "72181"},
              {"numero_dpe": "X3", "date_derniere_modification_dpe": "2024-07-01", "etiquette_dpe": "d",
               "adresse_brut": "12 rue haute", "code_insee_ban": "44184"},
              {"numero_dpe": "X4", "date_derniere_modification_dpe": "2024-07-01", "etiquette_dpe": "e",
               "adresse_brut": "14 Rue Hautte", "code_insee_ban": "72181"}]
    st = [{"code_uic": "g1", "libelle": "Le Mans", "commune": "Ailleurs", "departemen": "72", "c_geo": {"lon": 0.19, "lat": 47.99}}]
    _w(f"{tmp}/m/gares/p0.json", json.dumps({"results": st}))
    _w(f"{tmp}/m/dpe.csv", _audit_csv(audits))
    out = build.run(spark, build.Landing(sales=f"{tmp}/m/dvf.csv", addresses=f"{tmp}/m/adr", zones=f"{tmp}/m/zones.json",
                                         schools=f"{tmp}/m/schools.json", stations=f"{tmp}/m/gares", audits=f"{tmp}/m/dpe.csv"), f"{tmp}/mout")
    read = lambda t: spark.read.parquet(out[t]).collect()
    rows = {r.adresse_numero: r for r in read("ventes")}
    assert len(rows) == 4
    assert (rows[12].zone_bruit, rows[12].n_ecoles, rows[12].ecole_proche, rows[12].numero_dpe) == ("A", 2, "e1", "X2")
    assert (rows[12].n_parcels, rows[12].dpe_match, rows[14].n_parcels, rows[14].dpe_match, rows[14].numero_dpe) == (
        3, "exact", 1, "similar", "X4")
    assert (rows[12].n_gares, rows[12].gare_proche, rows[0].n_gares) == (1, "g1", None) and 1000 < rows[12].distance_gare_m < 2000
    assert [r.n_rejected for r in read("dvf_rejected")] == [2] and len(read("dvf")) == 6
    assert (rows[14].longitude, rows[14].coord_source, rows[14].zone_bruit, rows[14].n_ecoles) == (0.21, "reference", "C", 0)
    assert (rows[0].longitude, rows[0].zone_bruit, rows[0].numero_dpe, rows[0].n_ecoles) == (None, None, None, None)
    assert {(r.nom_commune, r.type_local, r.grouping_level): r.median_price for r in read("prix")}[("Le Mans", "Maison", 0)] == 2000
    assert sorted(r.verdict for r in read("verdicts")) == ["above", "below", "fair"]
    assert [r.n_rejected for r in read("adresses_rejected")] == [1]
    assert [r.n_rejected for r in read("zones_rejected")] == [1]


def test_api_slices(spark, tmp):
    r = {"numero_dpe": "A", "date_derniere_modification_dpe": "2024-03-01", "etiquette_dpe": "d",
         "conso_5_usages_ep": "10", "code_region_ban": "52"}
    _w(f"{tmp}/api/region=52/year=2024/p0.json", json.dumps({"total": 2, "results": [r, dict(r, numero_dpe="B")]}))
    _w(f"{tmp}/api/region=53/year=2025/p0.json", json.dumps({"total": 9, "results": [dict(r, numero_dpe="")]}))
    audits, comp, missing = audit_api.load(spark, f"{tmp}/api")
    assert sorted(x.numero_dpe for x in audits.collect()) == ["A", "B"]
    assert {(c.region, c.complete) for c in comp.collect()} == {("52", True), ("53", False)}
    assert "conso_5 usages_ef" in missing
    only52, _, _ = audit_api.load(spark, f"{tmp}/api", regions=[52])
    assert only52.count() == 2
