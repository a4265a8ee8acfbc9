"""Registered queries of sources, sinks and single operators.

Each lands whole driver tables as files of the form a source reads, in a fresh
folder of the session's shared checkpoint directory, and reads them back
through the library; the sink queries write and read tables there.  Rows that a
rule rejects are derived from the data by a fixed rule on the key, written
the same way in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valora import sinks
from valora.functions import expired, point, try_double
from valora.operators.joins import spread_join
from valora.operators.ranking import wide_hash_id
from valora.operators.sizing import attach_one_row
from valora.operators.skew import skew_join
from valora.operators.star import sales_address_view
from valora.plans.build import load_sales
from valora.plans.catalog import QUERIES, _landing, query, table
from valora.sources.delimited import read_delimited, stringify_all
from valora.sources.geojson import noise_zones
from valora.sources.json_pages import (
    read_cursor_slices, read_offset_pages, read_points, read_slice_pages, slice_completeness, stations_table,
)

__all__ = ["QUERIES"]


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# ------------------------------------------------------------ delimited files

@query("sales_wide_gzip", """
SELECT CAST(o_orderdate AS DATE) AS date_mutation, o_totalprice AS valeur_fonciere,
       COALESCE(CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) / 4 END, 0.0) AS surface_reelle_bati,
       o_orderkey AS adresse_numero, 'NR' AS adresse_suffixe, 'NR' AS adresse_code_voie,
       'rue "' || o_orderpriority || '", bis' AS adresse_nom_voie,
       CAST(0 AS INTEGER) AS nombre_pieces_principales,
       CASE WHEN o_orderkey % 3 = 0 THEN 'NR' ELSE o_orderstatus END AS type_local,
       CAST(NULL AS VARCHAR) AS nature_mutation, CAST(0.25 AS DOUBLE) AS longitude, CAST(0 AS DOUBLE) AS latitude,
       CAST(NULL AS VARCHAR) AS code_commune, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS code_postal,
       CAST(NULL AS VARCHAR) AS nom_commune, CAST(NULL AS VARCHAR) AS code_departement
FROM orders WHERE year(o_orderdate) IN (1997, 1998) AND o_orderkey % 11 <> 0
""")
def q_sales_wide_gzip(spark, d):
    """A gzip sales file with columns the load does not want, in an order of its
    own, with doubled quotes and separators inside quotes; prices that are no
    number (every 11th) are rejected, absent columns are NULL or filled."""
    root = _landing(spark, "sales")
    wide = table(spark, d, "orders").select(
        F.concat(F.lit("m-"), _text("o_orderkey")).alias("id_mutation"),
        F.lpad(_text("o_custkey"), 12, "0").alias("code_postal"),
        F.concat(F.lit('rue "'), "o_orderpriority", F.lit('", bis')).alias("adresse_nom_voie"),
        F.lit("0.25").alias("longitude"), F.lit("x, y").alias("ancien_nom"),
        F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(_text("o_totalprice")).alias("valeur_fonciere"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey") / 4).cast("string").alias("surface_reelle_bati"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("type_local"),
        _text("o_orderkey").alias("adresse_numero"), F.to_date("o_orderdate").cast("string").alias("date_mutation"))
    wide.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(root)
    return load_sales(spark, root, years=(1997, 1998))


@query("bad_rows_split", """
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate, 'good' AS row_kind
FROM lineitem WHERE l_orderkey % 13 NOT IN (0, 1, 2)
UNION ALL
SELECT l_orderkey, l_linenumber, NULL, NULL,
       CASE l_orderkey % 13 WHEN 0 THEN 'bad number' WHEN 1 THEN 'bad date' ELSE 'extra field' END
FROM lineitem WHERE l_orderkey % 13 IN (0, 1, 2)
""")
def q_bad_rows_split(spark, d):
    """Whole lineitem as delimited lines of which three kinds are bad: a price
    that is no number, a date that is none, a field too many."""
    root = _landing(spark, "bad-rows")
    k = F.col("l_orderkey") % 13
    line = F.concat_ws(",", _text("l_orderkey"), _text("l_linenumber"),
                       F.when(k == 0, "12f").otherwise(_text("l_extendedprice")),
                       F.when(k == 1, "1998-02-31").otherwise(F.to_date("l_shipdate").cast("string")),
                       F.when(k == 2, "extra"))
    table(spark, d, "lineitem").select(line.alias("value")).write.text(root)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_extendedprice", T.DoubleType()), T.StructField("l_shipdate", T.DateType())])
    good, bad = read_delimited(spark, root, schema=schema, header=False, keep_rejects=True)
    fields = F.split("raw_line", ",")
    kind = (F.when(F.size(fields) > 4, "extra field")
            .when(try_double(fields[2]).isNull(), "bad number").otherwise("bad date"))
    return good.withColumn("row_kind", F.lit("good")).unionByName(bad.select(
        fields[0].cast("long").alias("l_orderkey"), fields[1].cast("int").alias("l_linenumber"),
        F.lit(None).cast("double").alias("l_extendedprice"), F.lit(None).cast("date").alias("l_shipdate"),
        kind.alias("row_kind")))


@query("stringify_rows", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       COALESCE(CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS VARCHAR) END, '') AS c_nationkey,
       COALESCE(CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END, '') AS c_mktsegment
FROM customer
""")
def q_stringify_rows(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return stringify_all(c)


# ----------------------------------------------------------------- JSON pages

def _pages(records, key: str, record, size: int = 100, *slices):
    """Records as pages, one row a page: of ``size`` consecutive keys, or, with
    slices, as many pages as a slice of its number of rows needs."""
    page = F.floor(F.col(key) / size)
    if slices:
        pages = records.groupBy(*slices).agg(F.ceil(F.count(F.lit(1)) / size).alias("__pages"))
        records = records.join(pages, list(slices))
        page = F.pmod(F.xxhash64(key), F.col("__pages"))
    return records.groupBy(*slices, page.alias("__page")).agg(F.collect_list(record).alias("results")).drop("__page")


@query("station_pages", """
SELECT 'uic-' || s_suppkey AS code_uic, s_name AS libelle, n_name AS commune,
       CAST(s_nationkey AS VARCHAR) AS departemen,
       CASE WHEN s_suppkey % 6 <> 0 THEN s_acctbal / 100 END AS longitude,
       CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey / 100.0::DOUBLE END AS latitude
FROM supplier JOIN nation ON n_nationkey = s_nationkey
""")
def q_station_pages(spark, d):
    """Station pages, among them an empty one, with places missing."""
    root = _landing(spark, "stations")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    geo = F.struct((F.col("s_acctbal") / 100).alias("lon"), (F.col("s_suppkey") / F.lit(100.0)).alias("lat"))
    record = F.struct(F.concat(F.lit("uic-"), _text("s_suppkey")).alias("code_uic"), F.col("s_name").alias("libelle"),
                      F.col("n_name").alias("commune"), _text("s_nationkey").alias("departemen"),
                      F.when(F.col("s_suppkey") % 6 != 0, geo).alias("c_geo"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    pages = _pages(s, "s_suppkey", record)
    empty = pages.limit(1).select(F.slice("results", 1, 0).alias("results"))
    pages.unionByName(empty).repartition("results").write.option("maxRecordsPerFile", 1).json(root)
    return stations_table(spark, root)


@query("offset_pages", """
SELECT event_id, user_id, event_type, value FROM events
""")
def q_offset_pages(spark, d):
    root = _landing(spark, "event-pages")
    record = F.struct("event_id", "user_id", "event_type", "value")
    _pages(table(spark, d, "events"), "event_id", record, 1000).write.option("maxRecordsPerFile", 1).json(root)
    return read_offset_pages(spark, root, T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())]))


_SLICE_SQL = "o_orderpriority AS region, CAST(year(o_orderdate) AS VARCHAR) AS year"


def _landed_slices(spark, d) -> str:
    """Orders as cursor pages by priority and year.  Slices of 1995 announce more
    than they hold; every slice of 2099 is announced and empty."""
    root = _landing(spark, "slices")
    o = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("region"), F.year("o_orderdate").cast("string").alias("year"), "o_orderkey",
        F.struct(_text("o_orderkey").alias("numero_dpe"), F.col("o_orderstatus").alias("etiquette_dpe")).alias("r"))
    totals = o.groupBy("region", "year").agg(
        (F.count(F.lit(1)) + F.when(F.col("year") == "1995", 1).otherwise(0)).alias("total"))
    pages = _pages(o, "o_orderkey", "r", 1000, "region", "year").join(totals, ["region", "year"])
    gaps = o.select("region").distinct().select(
        "region", F.lit("2099").alias("year"), F.array().cast(pages.schema["results"].dataType).alias("results"),
        F.lit(500).cast("long").alias("total"))
    pages.unionByName(gaps).write.partitionBy("region", "year").option("maxRecordsPerFile", 1).json(root)
    return root


_ORDER_RECORD = T.StructType([T.StructField("numero_dpe", T.StringType()),
                              T.StructField("etiquette_dpe", T.StringType())])


@query("slice_completeness", f"""
WITH s AS (SELECT {_SLICE_SQL} FROM orders)
SELECT region, year, COUNT(*) AS n_rows, COUNT(*) + CASE WHEN year = '1995' THEN 1 ELSE 0 END AS total,
       year <> '1995' AS complete
FROM s GROUP BY region, year
UNION ALL SELECT DISTINCT region, '2099', 0, 500, false FROM s
""")
def q_slice_completeness(spark, d):
    return slice_completeness(read_slice_pages(spark, _landed_slices(spark, d), _ORDER_RECORD))


@query("cursor_slices", f"""
SELECT {_SLICE_SQL}, COUNT(*) OVER (PARTITION BY o_orderpriority, year(o_orderdate))
         + CASE WHEN year(o_orderdate) = 1995 THEN 1 ELSE 0 END AS _slice_total,
       CAST(o_orderkey AS VARCHAR) AS numero_dpe, o_orderstatus AS etiquette_dpe
FROM orders
""")
def q_cursor_slices(spark, d):
    return read_cursor_slices(spark, _landed_slices(spark, d), _ORDER_RECORD)


@query("point_records", """
SELECT c_custkey, c_name,
       CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN c_acctbal / 1000 END AS point_lon,
       CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS point_lat,
       c_acctbal / 1000 AS own_lon
FROM customer
""")
def q_point_records(spark, d):
    """Records with coordinates, one of which may be missing, as JSON lines."""
    root = _landing(spark, "points")
    c = table(spark, d, "customer")
    c.select("c_custkey", "c_name", (F.col("c_acctbal") / 1000).alias("x"),
             F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal") / 1000).alias("longitude"),
             F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey").cast("double")).alias("latitude")).write.json(root)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           *(T.StructField(n, T.DoubleType()) for n in ("x", "longitude", "latitude"))])
    read = read_points(spark, root, schema, multiline=False)
    own = point("x", "latitude")
    return read.select("c_custkey", "c_name", F.col("point.lon").alias("point_lon"),
                       F.col("point.lat").alias("point_lat"), own["lon"].alias("own_lon"))


# ---------------------------------------------------------------------- zones

@query("zone_features", """
SELECT s_nationkey AS feature, 'zone ' || s_suppkey AS "NOM", CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS "ZONE",
       (SELECT COUNT(*) FROM supplier WHERE s_suppkey % 5 IN (0, 1, 2)) AS n_rejected
FROM supplier WHERE s_suppkey % 5 NOT IN (0, 1, 2)
""")
def q_zone_features(spark, d):
    """One feature collection per nation: a square a supplier; of five, one has
    no geometry, one an unknown type, one a ring of three places."""
    root = _landing(spark, "zones")
    s, k = table(spark, d, "supplier"), F.col("s_suppkey") % 5
    x, y = F.col("s_nationkey").cast("double"), F.col("s_acctbal") / 100
    corner = [F.array(x, y), F.array(x + 1, y), F.array(x + 1, y + 1), F.array(x, y + 1)]
    ring = F.when(k == 2, F.array(*corner[:3])).otherwise(F.array(*corner, corner[0]))
    geometry = F.when(k != 0, F.struct(F.when(k == 1, "Circle").otherwise("Polygon").alias("type"),
                                       F.array(ring).alias("coordinates")))
    properties = F.struct(F.when(F.col("s_suppkey") % 2 == 0, "A").otherwise("B").alias("ZONE"),
                          F.concat(F.lit("zone "), _text("s_suppkey")).alias("NOM"),
                          F.col("s_nationkey").alias("feature"))
    (s.groupBy("s_nationkey").agg(F.collect_list(F.struct(properties.alias("properties"), geometry.alias("geometry")))
                                  .alias("features"))
     .select(F.lit("FeatureCollection").alias("type"), "features")
     .write.option("maxRecordsPerFile", 1).json(root))
    fields = T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("NOM", T.StringType()),
                           T.StructField("ZONE", T.StringType())])
    attributes, _, rejected = noise_zones(spark, root, properties=fields)
    return attach_one_row(attributes, rejected)


# ---------------------------------------------------------------------- sinks

@query("table_lifecycle", """
SELECT o_orderstatus, COUNT(*) AS n_rows, COUNT(DISTINCT o_custkey) AS n_customers, false AS still_there
FROM orders GROUP BY 1
""")
def q_table_lifecycle(spark, d):
    """Create or replace a partitioned table (twice), read it, register it as a
    view, query the view twice as a temp table, drop the view."""
    import uuid
    root, name = _landing(spark, "lifecycle"), f"v_{uuid.uuid4().hex}"
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.write_table(o.select("o_orderkey", "o_orderstatus"), root)
    sinks.write_table(o, root, partition_by=["o_orderstatus"])
    sinks.create_view(sinks.read_table(spark, root), name)
    kept = sinks.temp_persist(spark.sql(f"SELECT o_orderstatus, o_custkey FROM {name}"))
    out = (kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))
           .join(kept.distinct().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_customers")), "o_orderstatus"))
    sinks.drop_view(spark, name)
    return out.withColumn("still_there", F.lit(spark.catalog.tableExists(name)))


@query("describe_tables", """
SELECT column_name, CASE data_type WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string'
                                   WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS column_type,
       (SELECT COUNT(*) FROM orders) AS n_rows
FROM (DESCRIBE SELECT * FROM orders) AS t(column_name, data_type, a, b, c, e)
""")
def q_describe_tables(spark, d):
    """Columns and types of a table, beside its row count."""
    o = table(spark, d, "orders")
    return attach_one_row(sinks.describe(o), sinks.row_count(o))


# ------------------------------------------------------------------ operators

@query("expired_today", """
SELECT o_orderkey, CAST(o_orderdate + INTERVAL 9500 DAY AS DATE) AS valid_until,
       CAST(o_orderdate + INTERVAL 9500 DAY AS DATE) < current_date AS is_expired
FROM orders
""")
def q_expired_today(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_add("o_orderdate", 9500).alias("valid_until")).withColumn(
        "is_expired", expired("valid_until"))


@query("sales_address_view", """
SELECT l_orderkey, l_partkey AS adresse_numero, 'RUE ' || l_returnflag AS adresse_nom_voie,
       'rue ' || lower(l_returnflag) AS adresse_nom_voie_clean, CAST(l_suppkey AS VARCHAR) AS code_postal,
       numero AS adr_numero, nom_voie AS adr_nom_voie, code_postal AS adr_code_postal, nom_voie AS adresses_nom_voie_officiel
FROM lineitem JOIN (SELECT DISTINCT l_partkey AS numero, 'Rue ' || lower(l_returnflag) AS nom_voie,
                           CAST(l_suppkey AS VARCHAR) AS code_postal FROM lineitem WHERE l_partkey % 3 <> 0) AS adr
  ON l_partkey = numero AND lower('RUE ' || l_returnflag) = lower(nom_voie) AND CAST(l_suppkey AS VARCHAR) = adr.code_postal
""")
def q_sales_address_view(spark, d):
    li = table(spark, d, "lineitem")
    sales = li.select("l_orderkey", F.col("l_partkey").alias("adresse_numero"),
                      F.concat(F.lit("RUE "), "l_returnflag").alias("adresse_nom_voie"),
                      _text("l_suppkey").alias("code_postal"))
    adr = li.where(F.col("l_partkey") % 3 != 0).select(
        F.col("l_partkey").alias("numero"), F.concat(F.lit("Rue "), F.lower("l_returnflag")).alias("nom_voie"),
        _text("l_suppkey").alias("code_postal")).distinct()
    return sales_address_view(sales, adr)


@query("fill_key_join", """
WITH s AS (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 3 WHEN 0 THEN 0 ELSE l_partkey END AS numero,
                  CASE l_orderkey % 6 WHEN 0 THEN 'NR' WHEN 1 THEN NULL ELSE l_returnflag END AS voie FROM lineitem),
a AS (SELECT numero, voie, MIN(l_orderkey * 10 + l_linenumber) AS id_adresse FROM s
      WHERE numero % 2 = 0 AND voie IS NOT NULL GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, s.numero, s.voie, id_adresse
FROM s LEFT JOIN a ON s.numero = a.numero AND s.voie = a.voie
""")
def q_fill_key_join(spark, d):
    """A sixth of all rows has the fill key, another sixth a NULL key."""
    k = F.col("l_orderkey")
    s = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(k % 3 == 0, 0).otherwise(F.col("l_partkey")).alias("numero"),
        F.when(k % 6 == 0, "NR").when(k % 6 != 1, F.col("l_returnflag")).alias("voie"))
    a = (s.where((F.col("numero") % 2 == 0) & F.col("voie").isNotNull()).groupBy("numero", "voie")
         .agg(F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_adresse")))
    return spread_join(s, a, ["numero", "voie"], how="left", hot=(0, "NR")).select(
        "l_orderkey", "l_linenumber", "numero", "voie", "id_adresse")


@query("frequent_key_join", """
WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN (SELECT MAX(l_partkey) FROM lineitem)
                  WHEN l_orderkey % 7 = 1 THEN NULL ELSE l_partkey END AS place FROM lineitem),
a AS (SELECT place, COUNT(*) AS n_sales, MIN(l_orderkey) AS first_sale FROM s GROUP BY place)
SELECT l_orderkey, l_linenumber, s.place, n_sales, first_sale FROM s LEFT JOIN a ON s.place = a.place
""")
def q_frequent_key_join(spark, d):
    """A third of all rows has one key, which the join finds out."""
    li = table(spark, d, "lineitem")
    top = li.agg(F.max("l_partkey").alias("__top"))
    s = attach_one_row(li.select("l_orderkey", "l_linenumber", "l_partkey"), top).select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.col("__top"))
        .when(F.col("l_orderkey") % 7 != 1, F.col("l_partkey")).alias("place"))
    a = s.groupBy("place").agg(F.count(F.lit(1)).alias("n_sales"), F.min("l_orderkey").alias("first_sale"))
    return skew_join(s, a, ["place"], "left").select("l_orderkey", "l_linenumber", "place", "n_sales", "first_sale")


@query("wide_hash_ids", """
SELECT COUNT(*) AS n_addresses, COUNT(*) AS n_ids
FROM (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem)
""")
def q_wide_hash_ids(spark, d):
    """As many 128-bit ids as addresses."""
    key = ["l_partkey", "l_suppkey", "l_returnflag"]
    ids = table(spark, d, "lineitem").select(*key).distinct().withColumn("id", wide_hash_id(*key))
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_addresses"), F.count(F.lit(1)).alias("n_ids"))


@query("quoted_line_breaks", """
SELECT o_orderkey, o_custkey,
       CASE o_orderkey % 3 WHEN 0 THEN o_orderpriority || chr(10) || 'of "' || o_orderstatus || '", again'
            WHEN 1 THEN chr(10) || chr(10) || o_orderpriority ELSE o_orderpriority END AS note,
       CASE WHEN o_orderkey % 11 = 0 THEN 'extra field' ELSE 'good' END AS row_kind
FROM orders
""")
def q_quoted_line_breaks(spark, d):
    """Whole orders as delimited records whose notes hold line breaks, quotes
    and separators, some with a field too many, read in splits."""
    root = _landing(spark, "quoted-lines")
    k = F.col("o_orderkey") % 3
    note = (F.when(k == 0, F.concat("o_orderpriority", F.lit('\nof ""'), "o_orderstatus", F.lit('"", again')))
            .when(k == 1, F.concat(F.lit("\n\n"), "o_orderpriority")).otherwise(F.col("o_orderpriority")))
    record = F.concat_ws(",", _text("o_orderkey"), _text("o_custkey"), F.concat(F.lit('"'), note, F.lit('"')),
                         F.when(F.col("o_orderkey") % 11 == 0, "extra"))
    table(spark, d, "orders").select(record.alias("value")).write.text(root)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("note", T.StringType())])
    good, bad = read_delimited(spark, root, schema=schema, header=False, keep_rejects=True, multi_line=True)
    return good.withColumn("row_kind", F.lit("good")).unionByName(bad.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "note",
        F.lit("extra field").alias("row_kind")))
