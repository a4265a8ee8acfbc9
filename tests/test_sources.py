"""Landed-file sources: rows from FIXTURES.md written to temp files and read back."""

import gzip
import json
import os

from pyspark.sql import functions as F

from valora import schemas
from valora.sources.delimited import read_delimited, read_delimited_by_header, stringify_all
from valora.sources.geojson import noise_zones
from valora.sources.json_pages import (
    STATION_RECORD, read_cursor_slices, read_points, read_slice_pages, slice_completeness, stations_table,
)
from valora.sources.reconcile import reconcile
from valora import sinks


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def test_union_by_name_across_headers(spark, tmp):
    _write(f"{tmp}/a/adresses-01.csv", "numero;nom_voie;code_postal;lon;lat;extra_a\n"
           "1;rue A;01000;5.1;46.2;x\n2;rue B;01000;5.2;46.3;y\n3;rue C;01000;5.3;46.4;z;TOO;MANY\n")
    _write(f"{tmp}/a/adresses-2A.csv", "code_postal;lat;lon;numero;nom_voie;extra_b\n"
           "20000;41.9;8.7;10;cours Napoleon;q\n20000;41.8;8.6;abc;rue X;r\n20000;41.7\n")
    _write(f"{tmp}/a/other.csv", "ignored;file\n1;2\n")
    good, bad = read_delimited_by_header(spark, f"{tmp}/a", ";", "adresses-*.csv",
                                         types=schemas.ADDRESS_TYPES, keep_rejects=True)
    rows = {(r.numero, r.nom_voie): r for r in good.collect()}
    assert set(good.columns) >= {"numero", "nom_voie", "code_postal", "lon", "lat", "extra_a", "extra_b"}
    # columns landed by name, not by position
    assert rows[(10, "cours Napoleon")].lon == 8.7 and rows[(10, "cours Napoleon")].code_postal == "20000"
    assert rows[(1, "rue A")].extra_b is None and rows[(1, "rue A")].code_postal == "01000"
    assert len(rows) == 3            # extra-field row, short row and non-numeric numero rejected
    assert bad.count() == 3


def test_gzip_sales_read_and_clean(spark, tmp):
    header = ",".join(c for c, _ in schemas.SALES_COLUMNS)
    lines = [
        "2024-03-01,250000.5,80,12,,,rue Haute,4,Appartement,Vente,5.1,46.2,01053,01000,Bourg,01",
        "2023-12-31,100000,50,1,,,rue Basse,2,Maison,Vente,5.0,46.0,01053,01000,Bourg,01",
        "2025-06-30,,60,3,,,rue Vide,3,Maison,Vente,5.0,46.0,01053,01000,Bourg,01",
        "2025-01-15,300000,,,,,,,,Vente,,,2A004,,Ajaccio,2A",
        "not-a-date,1,1,1,,,x,1,y,Vente,1,1,1,1,z,1",
    ]
    _write(f"{tmp}/s/dvf.csv.gz", header + "\n" + "\n".join(lines) + "\n", gz=True)
    from valora.plans.build import load_sales
    out = load_sales(spark, f"{tmp}/s/dvf.csv.gz", partitions=4).orderBy("date_mutation").collect()
    assert [r.valeur_fonciere for r in out] == [250000.5, 300000.0]
    ajaccio = out[1]
    assert ajaccio.code_postal == "NR" and ajaccio.adresse_nom_voie == "NR" and ajaccio.longitude == 0
    assert ajaccio.code_commune == "2A004" and out[0].code_postal == "01000"


def test_pipe_file_all_text_and_keep_list(spark, tmp):
    _write(f"{tmp}/p/vf.txt", "Valeur fonciere|Surface reelle bati|Type local|Code postal|Voie|Autre\n"
           "120000,50|45|Maison|01000|RUE A|z\n|30||||z\n")
    raw = read_delimited(spark, f"{tmp}/p/vf.txt", sep="|", all_text=True)
    assert all(t == "string" for _, t in raw.dtypes)
    kept, missing = reconcile(raw, schemas.SALES_RAW_PIPE_COLUMNS, fill_missing=False)
    assert "Autre" not in kept.columns and "Commune" in missing
    assert kept.collect()[0]["Valeur fonciere"] == "120000,50"
    from valora.plans.exploration import explore_raw_sales
    res = explore_raw_sales(spark, f"{tmp}/p/vf.txt")
    prof = {r.column_name: r.n for r in res["profile"].collect()}
    assert prof["Valeur fonciere"] == 1 and prof["Type local"] == 1
    assert res["clean"].count() == 1 and res["residual"].count() == 0


def test_station_pages(spark, tmp):
    recs = [{"code_uic": "1", "libelle": "Le Mans", "commune": "Le Mans", "departemen": "Sarthe",
             "c_geo": {"lon": 0.19, "lat": 47.99}},
            {"code_uic": "2", "libelle": "Nowhere", "commune": None, "departemen": None, "c_geo": None}]
    _write(f"{tmp}/g/page-0.json", json.dumps({"results": recs}))
    _write(f"{tmp}/g/page-1.json", json.dumps({"results": []}))
    st = stations_table(spark, f"{tmp}/g").orderBy("code_uic").collect()
    assert [(r.libelle, r.latitude, r.longitude) for r in st] == [("Le Mans", 47.99, 0.19), ("Nowhere", None, None)]
    assert "c_geo" not in st[0].asDict()


def test_cursor_slices_and_completeness(spark, tmp):
    rec = {"numero_dpe": "D1", "date_derniere_modification_dpe": "2024-02-01"}
    _write(f"{tmp}/api/region=52/year=2024/p0.json", json.dumps({"total": 3, "results": [rec, rec], "next": "u"}))
    _write(f"{tmp}/api/region=52/year=2024/p1.json", json.dumps({"total": 3, "results": [rec], "next": None}))
    _write(f"{tmp}/api/region=53/year=2024/p0.json", json.dumps({"total": 5, "results": [rec], "next": None}))
    recs = read_cursor_slices(spark, f"{tmp}/api", schemas.AUDIT_API_TEXT)
    comp = {(r.region, r.year): (r.n_rows, r.total, r.complete) for r in slice_completeness(
        read_slice_pages(spark, f"{tmp}/api", schemas.AUDIT_API_TEXT)).collect()}
    assert comp == {("52", "2024"): (3, 3, True), ("53", "2024"): (1, 5, False)}


def test_geojson_zones_validity(spark, tmp):
    feats = [
        {"properties": {"ZONE": "A", "NOM": "p"}, "geometry": {"type": "Polygon",
         "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}},
        {"properties": {"ZONE": "B", "NOM": "m"}, "geometry": {"type": "MultiPolygon",
         "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"properties": {"ZONE": "C", "NOM": "hole"}, "geometry": {"type": "Polygon",
         "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]}},
        {"properties": {"ZONE": "D", "NOM": "null"}, "geometry": None},
        {"properties": {"ZONE": "D", "NOM": "circle"}, "geometry": {"type": "Circle", "coordinates": [0, 0]}},
        {"properties": {"ZONE": "D", "NOM": "short"}, "geometry": {"type": "Polygon",
         "coordinates": [[[0, 0], [1, 1]]]}},
    ]
    _write(f"{tmp}/z/zones.geojson", json.dumps({"type": "FeatureCollection", "features": feats}))
    attrs, geoms, rejected = noise_zones(spark, f"{tmp}/z/zones.geojson")
    assert sorted(r.NOM for r in attrs.collect()) == ["hole", "m", "p"]
    assert rejected.collect()[0].n_rejected == 3
    attrs2, _, rej2 = noise_zones(spark, f"{tmp}/z/zones.geojson", keep_null_geometry=True)
    assert attrs2.count() == 4 and rej2.collect()[0].n_rejected == 2
    from valora.operators.spatial import points_in_zones, zone_edges
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 5.6, 5.2), (4, 3.0, 3.5), (5, 9.0, 9.0)],
                                "id int, x double, y double")
    inside = points_in_zones(pts, zone_edges(geoms, "NOM"), ["id"], "x", "y")
    got = sorted((r.id, r.zone) for r in inside.collect())
    assert got == [(1, "hole"), (1, "m"), (1, "p"), (2, "m"), (3, "m"), (4, "hole")]


def test_points_and_sinks(spark, tmp):
    _write(f"{tmp}/sc/schools.json", json.dumps([{"nom": "a", "longitude": 2.3, "latitude": 48.8},
                                                 {"nom": "b", "longitude": None, "latitude": 48.0}]))
    pts = read_points(spark, f"{tmp}/sc/schools.json").orderBy("nom").collect()
    assert pts[0].point.lon == 2.3 and pts[1].point is None
    df = spark.createDataFrame([(1, None)], "a int, b string")
    sinks.write_table(stringify_all(df), f"{tmp}/out/t")
    back = sinks.read_table(spark, f"{tmp}/out/t").collect()[0]
    assert back.a == "1" and back.b == ""
    sinks.create_view(df, "v_test")
    assert spark.sql("SELECT COUNT(*) AS n FROM v_test").collect()[0].n == 1
    assert sinks.drop_view(spark, "v_test")
    assert [tuple(r) for r in sinks.describe(df).collect()] == [("a", "int"), ("b", "string")]


def test_sink_helpers_and_hash_id(spark):
    from valora.operators.ranking import hash_id
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "k int, s string, x double")
    p = sinks.temp_persist(df)
    assert sinks.row_count(p).collect()[0].n_rows == 2
    assert sinks.drop_columns(p, "x").columns == ["k", "s"]
    ids = [r.h for r in df.select(hash_id("k", "s").alias("h")).collect()]
    assert len(set(ids)) == 2 and ids == [r.h for r in df.select(hash_id("k", "s").alias("h")).collect()]
    p.unpersist()


def test_sales_by_name_with_quotes(spark, tmp):
    """Extra columns, another order, doubled quotes and line breaks in quotes."""
    import os
    from valora.plans.build import load_sales
    os.makedirs(f"{tmp}/s")
    with open(f"{tmp}/s/sales.csv", "w", newline="") as f:
        f.write('extra,valeur_fonciere,date_mutation,adresse_nom_voie,code_postal\r\n'
                'x,100.5,2024-01-02,"rue ""X"", bis",01000\r\n'
                'x,200,2025-03-04,"two\r\nlines",75001\r\n'
                'x,not a number,2024-01-02,bad,75001\r\n'
                'x,300,2023-01-02,old,75001\r\n')
    got = load_sales(spark, f"{tmp}/s", multi_line=True).collect()
    assert sorted((r.valeur_fonciere, r.adresse_nom_voie.replace("\r", ""), r.code_postal, r.adresse_numero) for r in got) == [
        (100.5, 'rue "X", bis', "01000", 0), (200.0, "two\nlines", "75001", 0)]


def test_empty_slice_is_reported(spark, tmp):
    import os
    os.makedirs(f"{tmp}/api/region=11/year=2024")
    with open(f"{tmp}/api/region=11/year=2024/p0.json", "w") as f:
        f.write('{"total": 500, "results": []}')
    got = slice_completeness(read_slice_pages(spark, f"{tmp}/api", schemas.AUDIT_API_TEXT)).collect()
    assert [(r.region, r.year, r.n_rows, r.total, r.complete) for r in got] == [("11", "2024", 0, 500, False)]


def _random_records(seed, count):
    import random
    r = random.Random(seed)
    cells = ["", "plain", "a,b", 'say ""x""', "two\nlines", "é\n\n,\n漢", "\n", "x" * 300, "12"]
    return [[str(k), r.choice(cells), r.choice(cells).replace('""', '"')] for k in range(count)]


def _quoted_line(row):
    return ",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\n') else c for c in row)


def test_line_breaks_in_quotes_over_many_splits(spark, tmp):
    """Against the plain parser, with splits far smaller than the records; one
    file holds most rows."""
    import csv
    files = {"a": _random_records(1, 600), "b": _random_records(2, 9), "c": []}
    for name, rows in files.items():
        _write(f"{tmp}/q/{name}.csv", "".join(_quoted_line(x) + "\n" for x in [["k", "u", "v"], *rows]))
    expected = []
    for name in files:
        with open(f"{tmp}/q/{name}.csv", newline="") as f:
            expected += [tuple(x or None for x in row) for row in list(csv.reader(f))[1:]]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("300", "9000", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            df = read_delimited(spark, f"{tmp}/q", multi_line=True, schema=schemas_text("k", "u", "v"))
            assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr), size
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def schemas_text(*names):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def test_quote_that_never_closes(spark, tmp):
    """Lines beyond the bound are records of their own; none is lost."""
    from valora.sources.quoted import read_records
    _write(f"{tmp}/o/a.csv", 'k,v\n1,x\n2,"open\n' + "".join(f"{k},y\n" for k in range(3, 40)))
    got = [r.value for r in read_records(spark, f"{tmp}/o", max_lines=5).collect()]
    assert sorted(got) == sorted(["k,v", "1,x", '2,"open\n' + "\n".join(f"{k},y" for k in range(3, 8))]
                                 + [f"{k},y" for k in range(8, 40)])


def test_rejects_and_header_of_quoted_files(spark, tmp):
    import pytest
    _write(f"{tmp}/r/a.csv", 'k,v\r\n1,"x\r\ny"\r\n\r\n2\r\n3,"a","b\nc"\r\n"4",z\r\n')
    good, bad = read_delimited(spark, f"{tmp}/r", multi_line=True, schema=schemas_text("k", "v"), keep_rejects=True)
    assert sorted(map(tuple, good.collect())) == [("1", "x\r\ny"), ("4", "z")] or sorted(
        map(tuple, good.collect())) == [("1", "x\ny"), ("4", "z")]
    assert sorted((r.k, r.raw_line) for r in bad.collect()) == [("2", "2"), ("3", '3,"a","b\nc"')]
    assert all(r.source_file.endswith("a.csv") for r in bad.collect())
    assert good.count() == 2 and bad.count() == 2
    with pytest.raises(Exception, match="other names"):
        read_delimited(spark, f"{tmp}/r", multi_line=True, schema=schemas_text("k", "w")).collect()


def _features(count):
    import random
    r = random.Random(5)
    names = ["plain", 'a "quoted" } name', "back\\slash\\", "{open", "}{", "é漢 }", "", "[,]"]
    out = []
    for k in range(count):
        ring = [[r.randint(0, 9), r.randint(0, 9)] for _ in range(r.choice([4, 4, 4, 200]))]
        out.append({"type": "Feature", "properties": {"ZONE": str(k), "NOM": r.choice(names), "more": {"a": {"b": [{}, "}"]}}},
                    "geometry": r.choice([None, {"type": "Polygon", "coordinates": [ring]}])})
    return out


def test_geojson_over_many_splits(spark, tmp):
    """One-line, indented and empty collections with braces and quotes in names,
    in splits smaller than a feature, against the plain parser."""
    from pyspark.sql import types as T
    from valora.sources.geojson import read_features
    from valora.sources.json_split import read_objects
    crs = {"type": "name", "properties": {"name": "urn:x"}, "geometry": {"type": "Polygon"}}
    one, two = _features(120), _features(20)
    _write(f"{tmp}/g/a.json", json.dumps({"type": "FeatureCollection", "na{me": "x}", "crs": crs, "features": one}))
    _write(f"{tmp}/g/b.json", json.dumps({"features": two, "type": "FeatureCollection", "crs": crs}, indent=2, ensure_ascii=False) + "\n")
    _write(f"{tmp}/g/c.json", '{"type": "FeatureCollection", "features": []}')
    _write(f"{tmp}/l/a.json", json.dumps([{"n": f["properties"]} for f in one]) + "\n")
    expected = sorted((f["properties"]["ZONE"], f["properties"]["NOM"], f["geometry"] and json.dumps(f["geometry"]["coordinates"]))
                      for f in one + two)
    fields = T.StructType([T.StructField("ZONE", T.StringType()), T.StructField("NOM", T.StringType())])
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("700", "9000", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = read_features(spark, f"{tmp}/g", fields).collect()
            assert sorted(((r.ZONE, r.NOM, r.geometry and json.dumps(json.loads(r.geometry.coordinates))) for r in got),
                          key=repr) == sorted(expected, key=repr), size
            listed = [json.loads(r.value) for r in read_objects(spark, f"{tmp}/l", 1).collect()]
            assert sorted(map(repr, listed)) == sorted(repr({"n": f["properties"]}) for f in one), size
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
