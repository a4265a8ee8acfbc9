"""Registered queries over the driver tables.

Each query exercises one or more operators of SURVEY §2 through the
library, on whole tables (no id subsets, no row caps; ``preview`` keeps its
LIMIT because the limit is the feature).  The driver tables have no NULLs,
so where an operator is about missing or dirty values the query first
derives dirty columns from the data with a fixed rule (e.g. a NULL every
7th key); the rule is written identically in the DuckDB oracle next to it.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valora.functions import (
    first_non_blank, first_word_key, lower_key, sq_planar_distance,
    try_double, try_int_rounded, upper_trim, with_default, with_sentinel, year_in, day_between,
    expired,
)
from valora.operators.clean import AuditSpec, clean_audits, clean_sales, fill_numeric, fill_text, impute_median
from valora.operators.dedup import dedup_counts, group_transactions, latest_per_key
from valora.operators.joins import block_fanout, key_join, normalised_key_join, prefix_columns
from valora.operators.nearest import nearest_site
from valora.operators.market import (
    deal_verdict, geocode_fill, latest_audit_join, outlier_fences, outlier_filter, price_statistics,
)
from valora.operators.profile import missing_profile, residual_nulls
from valora.operators.quality import (
    audit_checks, duplicate_keys, label_distribution, qc_report, qc_totals,
)
from valora.operators.ranking import dense_id, exact_quantiles
from valora.operators.spatial import points_in_zones, proximity, zone_edges
from valora.operators.star import address_dimension, sale_facts, unique_addresses
from valora.sources.reconcile import reconcile

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ filters

@query("year_filter_not_null", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice
FROM orders
WHERE year(CAST(o_orderdate AS DATE)) IN (1997, 1998) AND o_totalprice IS NOT NULL
""")
def q_year_filter(spark, d):
    o = table(spark, d, "orders")
    return (o.where(year_in(o, "o_orderdate", [1997, 1998])).where(F.col("o_totalprice").isNotNull())
            .select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"),
                    F.year("o_orderdate").alias("order_year"), "o_totalprice"))


@query("slice_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-08-31' AND o_orderstatus = 'F'
""")
def q_slice_filter(spark, d):
    o = table(spark, d, "orders")
    return (o.where(day_between(o, "o_orderdate", "1996-03-01", "1996-08-31") & (F.col("o_orderstatus") == "F"))
            .select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"),
                    "o_totalprice"))


@query("slice_counts", """
SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS slice_year, COUNT(*) AS n
FROM orders
WHERE o_orderstatus IN ('F', 'O') AND year(o_orderdate) IN (1996, 1997)
GROUP BY 1, 2
""")
def q_slice_counts(spark, d):
    # row count per (status x year) slice: the completeness check of a
    # sliced load
    o = table(spark, d, "orders")
    return (o.where(F.col("o_orderstatus").isin("F", "O") & year_in(o, "o_orderdate", [1996, 1997]))
            .groupBy("o_orderstatus", F.year("o_orderdate").alias("slice_year"))
            .agg(F.count(F.lit(1)).alias("n")))


# -------------------------------------------------------------------- fills

@query("fill_numeric", """
SELECT p_partkey,
       COALESCE(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END, 0) AS p_size,
       COALESCE(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END, 0) AS p_retailprice
FROM part
""")
def q_fill_numeric(spark, d):
    p = table(spark, d, "part").selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice")
    return fill_numeric(p, ["p_size", "p_retailprice"], 0)


@query("fill_text", """
SELECT o_orderkey,
       COALESCE(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END, 'NR') AS o_orderstatus,
       COALESCE(CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END, 'NR') AS o_orderpriority
FROM orders
""")
def q_fill_text(spark, d):
    o = table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
        "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority")
    return fill_text(o, ["o_orderstatus", "o_orderpriority"])


_SALES_SQL = """
WITH s AS (
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS valeur_fonciere,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS surface_reelle_bati,
         CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS type_local,
         CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderstatus END AS code_postal
  FROM orders)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date_mutation, valeur_fonciere,
       COALESCE(surface_reelle_bati, 0) AS surface_reelle_bati,
       COALESCE(type_local, 'NR') AS type_local, COALESCE(code_postal, 'NR') AS code_postal
FROM s
WHERE year(o_orderdate) IN (1999, 2000) AND valeur_fonciere IS NOT NULL
"""


@query("sales_clean", _SALES_SQL)
def q_sales_clean(spark, d):
    # C1 as one composite: year range -> price not null -> 0 / 'NR' fills
    s = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_orderdate AS date_mutation",
        "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS valeur_fonciere",
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS surface_reelle_bati",
        "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS type_local",
        "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderstatus END AS code_postal")
    out = clean_sales(s, years=(1999, 2000))
    return out.select("o_orderkey", F.to_date("date_mutation").alias("date_mutation"), "valeur_fonciere",
                      "surface_reelle_bati", "type_local", "code_postal")


# -------------------------------------------------------------- projections

@query("star_exclude", """
WITH j AS (
  SELECT o.*, c.*, o.o_totalprice - c.c_acctbal AS rang
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT * EXCLUDE (rang, c_custkey, o_orderdate), CAST(o_orderdate AS DATE) AS order_date FROM j
""")
def q_star_exclude(spark, d):
    o = table(spark, d, "orders").alias("o")
    c = table(spark, d, "customer").alias("c")
    j = o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).select(
        "o.*", "c.*", (F.col("o.o_totalprice") - F.col("c.c_acctbal")).alias("rang"))
    return j.withColumn("order_date", F.to_date("o_orderdate")).drop("rang", "c_custkey", "o_orderdate")


@query("alias_project", """
SELECT o.o_orderkey AS order_id, o.o_custkey AS custkey, o.o_totalprice AS price,
       c.c_custkey AS cust_custkey, c.c_name AS cust_name, c.c_nationkey AS cust_nationkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_alias_project(spark, d):
    left = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                            F.col("o_custkey").alias("custkey"),
                                            F.col("o_totalprice").alias("price"))
    right = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
                                               F.col("c_nationkey").alias("nationkey"))
    right = prefix_columns(right, "cust_")   # both sides carry 'custkey' (P5)
    return left.join(right, F.col("custkey") == F.col("cust_custkey"))


@query("nested_field", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS geo_lon,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS DOUBLE) END AS geo_lat
FROM events
""")
def q_nested_field(spark, d):
    e = table(spark, d, "events")
    geo = F.when(F.col("event_type") != "error",
                 F.struct(F.col("value").alias("lon"), F.col("user_id").cast("double").alias("lat")))
    parsed = e.select("event_id", F.from_json("props", "k BIGINT").alias("p"), geo.alias("c_geo"))
    return parsed.select("event_id", F.col("p.k").alias("k"), F.col("c_geo.lon").alias("geo_lon"),
                         F.col("c_geo.lat").alias("geo_lat"))


@query("reconcile_columns", """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal, CAST(NULL AS VARCHAR) AS c_address
FROM customer
""")
def q_reconcile(spark, d):
    df, _missing = reconcile(table(spark, d, "customer"), ["c_custkey", "c_name", "c_phone", "c_acctbal", "c_address"])
    return df


# ------------------------------------------------------------- aggregations

@query("median_all", """
SELECT median(l_quantity) AS med_quantity, median(l_extendedprice) AS med_extendedprice,
       median(l_discount) AS med_discount, median(l_tax) AS med_tax
FROM lineitem
""")
def q_median_all(spark, d):
    li = table(spark, d, "lineitem")
    m = exact_quantiles(li, [], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], {"median": 0.5},
                        name_fmt="{col}")
    return m.select(*[F.col(f"l_{c}").alias(f"med_{c}") for c in ("quantity", "extendedprice", "discount", "tax")])


_FR_TEXT_SPARK = ("CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'n/a' "
                  "WHEN event_id % 17 = 0 THEN NULL "
                  "WHEN event_id % 19 = 0 THEN '1 ' || replace(CAST(CAST(value AS DECIMAL(10,2)) AS STRING), '.', ',') "
                  "ELSE replace(CAST(CAST(value AS DECIMAL(10,2)) AS STRING), '.', ',') END")
_FR_TEXT_SQL = _FR_TEXT_SPARK.replace("AS STRING", "AS VARCHAR")


# A French number: comma decimals, blanks between digits.  Its default is the
# middle value of what parses.
_NUMBER = "TRY_CAST(translate({c}, ', ', '.') AS DOUBLE)"


@query("french_number_impute", f"""
WITH texts AS (SELECT event_id, {_FR_TEXT_SQL} AS value_text FROM events),
parsed AS (SELECT event_id, value_text, {_NUMBER.format(c='value_text')} AS x FROM texts)
SELECT event_id, value_text, CASE WHEN x IS NULL THEN
         (SELECT ifnull(quantile_cont(x, 0.5), 0.0) FROM parsed WHERE length(trim(value_text)) > 0) ELSE x END AS value_clean
FROM parsed
""")
def q_french_number(spark, d):
    raw = table(spark, d, "events").selectExpr("event_id", f"{_FR_TEXT_SPARK} AS value_text")
    out = impute_median(raw.withColumn("value_clean", F.col("value_text")), ["value_clean"])
    return out.select("event_id", "value_text", "value_clean")


@query("default_category", """
WITH raw AS (
  SELECT p_partkey,
         CASE p_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN NULL
              WHEN 3 THEN '  ' || lower(p_type) || ' ' WHEN 4 THEN chr(160) || p_type || chr(160)
              ELSE p_type END AS raw_type
  FROM part)
SELECT p_partkey, COALESCE(NULLIF(TRIM(raw_type), ''), 'NR') AS type_clean,
       UPPER(TRIM(raw_type)) AS type_upper,
       COALESCE(NULLIF(TRIM(raw_type), ''), 'Inconnu') AS type_unknown
FROM raw
""")
def q_default_category(spark, d):
    raw = table(spark, d, "part").selectExpr(
        "p_partkey",
        "CASE p_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN NULL "
        "WHEN 3 THEN '  ' || lower(p_type) || ' ' WHEN 4 THEN chr(160) || p_type || chr(160) "
        "ELSE p_type END AS raw_type")
    return raw.select("p_partkey", with_default("raw_type").alias("type_clean"),
                      upper_trim("raw_type").alias("type_upper"),
                      with_default("raw_type", "Inconnu").alias("type_unknown"))


@query("fallback_chain", """
WITH raw AS (
  SELECT c_custkey,
         CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment END AS seg,
         CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END AS nm
  FROM customer)
SELECT c_custkey, COALESCE(NULLIF(TRIM(seg), ''), NULLIF(TRIM(nm), ''), 'NR') AS label FROM raw
""")
def q_fallback_chain(spark, d):
    raw = table(spark, d, "customer").selectExpr(
        "c_custkey", "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment END AS seg",
        "CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END AS nm")
    return raw.select("c_custkey", first_non_blank("seg", "nm").alias("label"))


_SENTINEL_SPARK = ("CASE event_id % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '12f' WHEN 2 THEN '1_000' "
                   "WHEN 3 THEN ' 4.5 ' WHEN 4 THEN '1d' "
                   "ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END")
_SCORE_SPARK = ("CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN NULL "
                "ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END")


@query("sentinel_numeric", f"""
SELECT event_id, {_SENTINEL_SPARK.replace('AS STRING', 'AS VARCHAR')} AS x_text,
       COALESCE(TRY_CAST({_SENTINEL_SPARK.replace('AS STRING', 'AS VARCHAR')} AS DOUBLE), -999) AS x_coord,
       COALESCE(TRY_CAST({_SCORE_SPARK.replace('AS STRING', 'AS VARCHAR')} AS DOUBLE), 0.0) AS score
FROM events
""")
def q_sentinel_numeric(spark, d):
    raw = table(spark, d, "events").selectExpr("event_id", f"{_SENTINEL_SPARK} AS x_text",
                                                f"{_SCORE_SPARK} AS score_text")
    return raw.select("event_id", "x_text", with_sentinel(try_double("x_text"), -999.0).alias("x_coord"),
                      with_sentinel(try_double("score_text"), 0.0).alias("score"))


_COMFORT_SPARK = ("CASE WHEN event_id % 11 = 0 THEN 'bon' WHEN event_id % 13 = 0 THEN '1e2' "
                  "WHEN event_id % 3 = 0 THEN '-' || CAST(event_id % 50 AS STRING) || '.' || CAST(event_id % 10 AS STRING) "
                  "ELSE CAST(event_id % 50 AS STRING) || '.' || CAST(event_id % 10 AS STRING) END")


@query("int_round_cast", f"""
WITH raw AS (SELECT event_id, {_COMFORT_SPARK.replace('AS STRING', 'AS VARCHAR')} AS comfort_text FROM events)
SELECT event_id, comfort_text, COALESCE(TRY_CAST(comfort_text AS INTEGER), 0) AS comfort FROM raw
""")
def q_int_round_cast(spark, d):
    raw = table(spark, d, "events").selectExpr("event_id", f"{_COMFORT_SPARK} AS comfort_text")
    return raw.select("event_id", "comfort_text",
                      F.coalesce(try_int_rounded("comfort_text"), F.lit(0)).alias("comfort"))


# audit-shaped raw text frame derived from events (all text, as the
# reference reads audits)
_AUDIT_RAW = [
    "CAST(event_id AS STRING) AS numero_dpe",
    "CAST(CAST(ts AS DATE) AS STRING) AS date_etablissement_dpe",
    "CAST(date_add(CAST(ts AS DATE), CAST(user_id % 40 AS INT) - 10) AS STRING) AS date_fin_validite_dpe",
    "CASE WHEN event_id % 8 = 0 THEN ' ' ELSE CAST(user_id AS STRING) END AS code_insee_ban",
    "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS nom_commune_ban",
    "CASE WHEN event_id % 4 = 0 THEN '' ELSE upper(event_type) END AS nom_commune_brut",
    "CASE WHEN event_id % 9 = 0 THEN 'abc' ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END "
    "AS coordonnee_cartographique_x_ban",
    "CASE WHEN event_id % 10 = 0 THEN NULL ELSE '0.5' END AS score_ban",
    "CASE WHEN event_id % 12 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS adresse_brut",
    "CASE WHEN event_id % 3 = 0 THEN ' ' || lower(substr('ABCDEFGH', CAST(event_id % 8 AS INT) + 1, 1)) || ' ' "
    "ELSE substr('ABCDEFGH', CAST(event_id % 8 AS INT) + 1, 1) END AS etiquette_dpe",
    f"{_FR_TEXT_SPARK} AS conso_5_usages_ep",
    "CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(CAST(value * 3 AS DECIMAL(10,2)) AS STRING) END "
    "AS cout_total_5_usages",
    "CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS zone_climatique",
    "event_type AS type_batiment",
    f"{_COMFORT_SPARK} AS indicateur_confort_ete",
    "CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS isolation_toiture",
]


def _audit_raw(spark, d):
    return table(spark, d, "events").selectExpr(*_AUDIT_RAW)


def _audit_raw_sql():
    return ",\n         ".join(x.replace("AS STRING", "AS VARCHAR") for x in _AUDIT_RAW)


def _or_default(columns: list[str], default: str) -> str:
    """First of ``columns`` with something but blanks in it, else a default."""
    arms = " ".join(f"WHEN length(trim({c})) > 0 THEN trim({c})" for c in columns)
    return f"CASE {arms} ELSE '{default}' END"


def _middle(c: str) -> str:
    return f"(SELECT ifnull(quantile_cont(n_{c}, 0.5), 0.0) FROM parsed WHERE length(trim({c})) > 0)"


_MEASURES = ["conso_5_usages_ep", "cout_total_5_usages"]

@query("audit_clean", f"""
WITH landed AS (SELECT {_audit_raw_sql()} FROM events),
parsed AS (SELECT *, {', '.join(f"{_NUMBER.format(c=c)} AS n_{c}" for c in _MEASURES)} FROM landed)
SELECT CASE WHEN numero_dpe <> '' THEN numero_dpe END AS numero_dpe,
       {', '.join(f"TRY_CAST({c} AS DATE) AS {c}" for c in ("date_etablissement_dpe", "date_fin_validite_dpe"))},
       {_or_default(["code_insee_ban"], "NR")} AS code_insee_ban,
       {_or_default(["nom_commune_ban", "nom_commune_brut"], "NR")} AS nom_commune_ban,
       ifnull(TRY_CAST(coordonnee_cartographique_x_ban AS DOUBLE), -999.0) AS coordonnee_cartographique_x_ban,
       ifnull(TRY_CAST(score_ban AS DOUBLE), 0.0) AS score_ban,
       {', '.join(f"ifnull({c}, '') AS {c}" for c in ("adresse_brut", "nom_commune_brut"))},
       upper(trim(etiquette_dpe)) AS etiquette_dpe,
       {', '.join(f"ifnull(n_{c}, {_middle(c)}) AS {c}" for c in _MEASURES)},
       {_or_default(["zone_climatique"], "NR")} AS zone_climatique, type_batiment,
       ifnull(TRY_CAST(indicateur_confort_ete AS INTEGER), 0) AS indicateur_confort_ete,
       {_or_default(["isolation_toiture"], "Inconnu")} AS isolation_toiture
FROM parsed
""")
def q_audit_clean(spark, d):
    return clean_audits(_audit_raw(spark, d), AuditSpec())


# ----------------------------------------------------------------- dedup

_DEDUP_BASE_SPARK = ["o_orderkey", "o_custkey", "o_totalprice",
                     "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date"]
_DEDUP_BASE_SQL = ", ".join(_DEDUP_BASE_SPARK)


@query("dedup_latest", f"""
WITH base AS (SELECT {_DEDUP_BASE_SQL} FROM orders)
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST, o_orderkey DESC) AS _rn
  FROM base WHERE o_custkey IS NOT NULL) WHERE _rn = 1
""")
def q_dedup_latest(spark, d):
    base = table(spark, d, "orders").selectExpr(*_DEDUP_BASE_SPARK)
    return latest_per_key(base, ["o_custkey"], [F.desc_nulls_last("order_date"), F.desc("o_orderkey")])


@query("dedup_removed_count", f"""
WITH base AS (SELECT {_DEDUP_BASE_SQL} FROM orders),
kept AS (SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY order_date DESC NULLS LAST, o_orderkey DESC) AS _rn
  FROM base WHERE o_custkey IS NOT NULL) WHERE _rn = 1)
SELECT (SELECT COUNT(*) FROM base) AS n_before, (SELECT COUNT(*) FROM kept) AS n_after,
       (SELECT COUNT(*) FROM base) - (SELECT COUNT(*) FROM kept) AS n_removed
""")
def q_dedup_removed(spark, d):
    base = table(spark, d, "orders").selectExpr(*_DEDUP_BASE_SPARK)
    kept = latest_per_key(base, ["o_custkey"], [F.desc_nulls_last("order_date"), F.desc("o_orderkey")])
    return dedup_counts(base, kept)


@query("sale_dedup", """
SELECT l_orderkey, l_returnflag, l_linestatus, COUNT(*) AS n_parcels, SUM(l_quantity) AS total_qty,
       MAX(l_extendedprice) AS max_price, MIN(l_linenumber) AS first_line
FROM lineitem GROUP BY 1, 2, 3
""")
def q_sale_dedup(spark, d):
    li = table(spark, d, "lineitem")
    return group_transactions(li, ["l_orderkey", "l_returnflag", "l_linestatus"], [
        F.sum("l_quantity").alias("total_qty"), F.max("l_extendedprice").alias("max_price"),
        F.min("l_linenumber").alias("first_line")])


# --------------------------------------------------------- profile and QC

_PROFILE_BASE_SPARK = [
    "CASE WHEN event_id % 10 = 0 THEN '' ELSE event_type END AS event_type",
    "CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS props",
    "CASE WHEN event_id % 3 = 0 THEN '  ' ELSE CAST(user_id AS STRING) END AS user_txt",
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value",
]


def _profile_sql():
    base = ", ".join(x.replace("AS STRING", "AS VARCHAR") for x in _PROFILE_BASE_SPARK)
    parts = []
    for name, pred in [("event_type", "event_type IS NULL OR TRIM(event_type) = ''"),
                       ("props", "props IS NULL OR TRIM(props) = ''"),
                       ("user_txt", "user_txt IS NULL OR TRIM(user_txt) = ''"),
                       ("value", "value IS NULL")]:
        parts.append(f"""SELECT '{name}' AS column_name, n, ROUND(100.0 * n / total, 2) AS pct,
       CASE WHEN ROUND(100.0 * n / total, 2) > 20 THEN 'high' WHEN ROUND(100.0 * n / total, 2) > 5 THEN 'medium'
            ELSE '' END AS flag
FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE {pred}) AS n FROM base)""")
    return f"WITH base AS (SELECT {base} FROM events)\n" + "\nUNION ALL\n".join(parts)


@query("missing_profile", _profile_sql())
def q_missing_profile(spark, d):
    base = table(spark, d, "events").selectExpr(*_PROFILE_BASE_SPARK)
    return missing_profile(base)


@query("residual_null", """
WITH base AS (
  SELECT o_orderkey,
         COALESCE(CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END, 'NR') AS o_orderpriority,
         CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM orders)
SELECT * FROM (
  SELECT 'o_orderkey' AS column_name, COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS n FROM base
  UNION ALL SELECT 'o_orderpriority', COUNT(*) FILTER (WHERE o_orderpriority IS NULL) FROM base
  UNION ALL SELECT 'o_totalprice', COUNT(*) FILTER (WHERE o_totalprice IS NULL) FROM base
  UNION ALL SELECT 'o_orderstatus', COUNT(*) FILTER (WHERE o_orderstatus IS NULL) FROM base)
WHERE n > 0
""")
def q_residual_null(spark, d):
    base = table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
        "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice",
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus")
    return residual_nulls(fill_text(base, ["o_orderpriority"]))


@query("dup_keys", """
SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING COUNT(*) > 1
""")
def q_dup_keys(spark, d):
    return duplicate_keys(table(spark, d, "orders"), "o_custkey")


@query("label_distribution", """
WITH base AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN ' ' || lower(o_orderstatus)
                          ELSE o_orderstatus END AS status FROM orders)
SELECT UPPER(TRIM(status)) AS label, COUNT(*) AS n FROM base WHERE status IS NOT NULL GROUP BY 1 ORDER BY 1
""")
def q_label_distribution(spark, d):
    base = table(spark, d, "orders").selectExpr(
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN ' ' || lower(o_orderstatus) "
        "ELSE o_orderstatus END AS status")
    return label_distribution(base, "status")


# audit-shaped frame for the QC checks, from lineitem joined to its order
_QC_FRAME_SQL = """
WITH a AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS numero_dpe, l_returnflag AS etiquette_dpe, l_linestatus AS etiquette_ges,
         CAST(l_shipdate AS DATE) AS date_etablissement_dpe, CAST(o_orderdate AS DATE) AS date_fin_validite_dpe,
         l_quantity * 45 - 100 AS surface_habitable_logement,
         l_extendedprice * (l_discount - 0.05) AS conso_5_usages_ep,
         l_tax * 12 - 0.1 AS score_ban
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (
  SELECT 'null_numero_dpe' AS check_name, COUNT(*) FILTER (WHERE numero_dpe IS NULL) AS n FROM a
  UNION ALL SELECT 'dup_numero_dpe', (SELECT COUNT(*) FROM (SELECT numero_dpe FROM a WHERE numero_dpe IS NOT NULL
                                      GROUP BY numero_dpe HAVING COUNT(*) > 1))
  UNION ALL SELECT 'invalid_etiquette_dpe', COUNT(*) FILTER (WHERE etiquette_dpe IS NOT NULL
            AND UPPER(TRIM(etiquette_dpe)) NOT IN ('A','B','C','D','E','F','G')) FROM a
  UNION ALL SELECT 'invalid_etiquette_ges', COUNT(*) FILTER (WHERE etiquette_ges IS NOT NULL
            AND UPPER(TRIM(etiquette_ges)) NOT IN ('A','B','C','D','E','F','G')) FROM a
  UNION ALL SELECT 'date_fin_avant_etablissement', COUNT(*) FILTER (WHERE date_fin_validite_dpe IS NOT NULL
            AND date_etablissement_dpe IS NOT NULL AND date_fin_validite_dpe < date_etablissement_dpe) FROM a
  UNION ALL SELECT 'surface_<=0', COUNT(*) FILTER (WHERE surface_habitable_logement <= 0) FROM a
  UNION ALL SELECT 'surface_>2000', COUNT(*) FILTER (WHERE surface_habitable_logement > 2000) FROM a
  UNION ALL SELECT 'conso_ep_negative', COUNT(*) FILTER (WHERE conso_5_usages_ep < 0) FROM a
  UNION ALL SELECT 'score_ban_hors_range', COUNT(*) FILTER (WHERE score_ban < 0 OR score_ban > 1) FROM a)
"""


def _qc_frame(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("numero_dpe"), F.col("l_returnflag").alias("etiquette_dpe"),
        F.col("l_linestatus").alias("etiquette_ges"), F.to_date("l_shipdate").alias("date_etablissement_dpe"),
        F.to_date("o_orderdate").alias("date_fin_validite_dpe"),
        (F.col("l_quantity") * 45 - 100).alias("surface_habitable_logement"),
        (F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("conso_5_usages_ep"),
        (F.col("l_tax") * 12 - 0.1).alias("score_ban"))


@query("qc_report", _QC_FRAME_SQL + "SELECT check_name, n FROM c WHERE n > 0 ORDER BY n DESC, check_name")
def q_qc_report(spark, d):
    return qc_report(_qc_frame(spark, d), audit_checks(), dup_key="numero_dpe")


@query("qc_totals", _QC_FRAME_SQL +
       "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_anomalies, COUNT(*) AS n_categories FROM c WHERE n > 0")
def q_qc_totals(spark, d):
    return qc_totals(qc_report(_qc_frame(spark, d), audit_checks(), dup_key="numero_dpe"))


@query("expired_as_of", """
SELECT COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1999-06-30') AS n_expired, COUNT(*) AS n_total
FROM orders
""")
def q_expired(spark, d):
    o = table(spark, d, "orders")
    return o.agg(F.count_if(expired(F.col("o_orderdate"), as_of="1999-06-30")).alias("n_expired"),
                 F.count(F.lit(1)).alias("n_total"))


# ------------------------------------------------------- distinct / unions

@query("distinct_addresses", """
SELECT DISTINCT l_suppkey AS numero, l_returnflag AS nom_voie, l_linestatus AS code_postal,
       CAST(l_linenumber AS VARCHAR) AS nom_commune, l_discount AS lon, l_tax AS lat,
       l_returnflag || l_linestatus AS code_insee
FROM lineitem
""")
def q_distinct_addresses(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("numero"), F.col("l_returnflag").alias("nom_voie"),
                     F.col("l_linestatus").alias("code_postal"),
                     F.col("l_linenumber").cast("string").alias("nom_commune"), F.col("l_discount").alias("lon"),
                     F.col("l_tax").alias("lat"), F.concat("l_returnflag", "l_linestatus").alias("code_insee")
                     ).distinct()


@query("union_slices", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS slice_year FROM orders WHERE year(o_orderdate) = 1996
UNION ALL SELECT o_orderkey, 1997 FROM orders WHERE year(o_orderdate) = 1997
UNION ALL SELECT o_orderkey, 1998 FROM orders WHERE year(o_orderdate) = 1998
""")
def q_union_slices(spark, d):
    o = table(spark, d, "orders")
    slices = [o.where(year_in(o, "o_orderdate", [y])).select("o_orderkey", F.lit(y).alias("slice_year"))
              for y in (1996, 1997, 1998)]
    return reduce(lambda a, b: a.unionByName(b), slices)


@query("union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment,
       CAST(NULL AS DOUBLE) AS acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR), s_acctbal FROM supplier
""")
def q_union_by_name(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                           F.col("c_nationkey").alias("nationkey"),
                                           F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                           F.col("s_acctbal").alias("acctbal"),
                                           F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s, allowMissingColumns=True).select("key", "name", "nationkey", "segment", "acctbal")


@query("row_count", "SELECT COUNT(*) AS n_rows FROM lineitem")
def q_row_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def q_preview(spark, d):
    # the limit is the feature here (O3); orderBy+limit plans as TakeOrderedAndProject
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(20)


# ------------------------------------------------------------------- joins

@query("equi3_join", """
WITH dim AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY numero, nom_voie, code_postal) AS id_adresse
  FROM (SELECT DISTINCT l_suppkey AS numero, l_returnflag AS nom_voie, l_linestatus AS code_postal FROM lineitem))
SELECT l_orderkey, l_partkey, l_suppkey, d.id_adresse
FROM lineitem JOIN dim d ON l_suppkey = d.numero AND l_returnflag = d.nom_voie AND l_linestatus = d.code_postal
""")
def q_equi3_join(spark, d):
    li = table(spark, d, "lineitem")
    dim = li.select(F.col("l_suppkey").alias("numero"), F.col("l_returnflag").alias("nom_voie"),
                    F.col("l_linestatus").alias("code_postal")).distinct()
    dim = dense_id(dim, ["numero", "nom_voie", "code_postal"], "id_adresse")
    facts = li.select("l_orderkey", "l_partkey", F.col("l_suppkey").alias("numero"),
                      F.col("l_returnflag").alias("nom_voie"), F.col("l_linestatus").alias("code_postal"))
    j = key_join(facts, dim, ["numero", "nom_voie", "code_postal"])
    return j.select("l_orderkey", "l_partkey", F.col("numero").alias("l_suppkey"), "id_adresse")


@query("lower_key_join", """
SELECT p.p_partkey, p.p_name AS name, lower('Nation_' || split_part(p.p_brand, '#', 2)) AS brand_key,
       n.n_nationkey AS adr_nationkey, n.n_name AS adr_name, n.n_regionkey AS adr_regionkey
FROM part p JOIN nation n ON lower('Nation_' || split_part(p.p_brand, '#', 2)) = lower(n.n_name)
""")
def q_lower_key_join(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("name"),
        F.concat(F.lit("Nation_"), F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("brand_raw"))
    n = prefix_columns(table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"),
                                                        F.col("n_name").alias("name"),
                                                        F.col("n_regionkey").alias("regionkey")), "adr_")
    j = normalised_key_join(p, n, [lower_key("brand_raw")], [lower_key("adr_name")])
    return j.select("p_partkey", "name", lower_key("brand_raw").alias("brand_key"), "adr_nationkey", "adr_name",
                    "adr_regionkey")


@query("first_word_join", """
WITH l AS (SELECT lower(split_part(trim(p_name), ' ', 1)) AS block_key, COUNT(*) AS n_left FROM part GROUP BY 1),
r AS (SELECT lower(split_part(trim(p_name), ' ', 1)) AS block_key, COUNT(*) AS n_right FROM part GROUP BY 1)
SELECT l.block_key, n_left, n_right, n_left * n_right AS n_pairs FROM l JOIN r ON l.block_key = r.block_key
""")
def q_first_word_join(spark, d):
    p = table(spark, d, "part")
    return block_fanout(p, p, first_word_key("p_name"), first_word_key("p_name"))


_NEAREST_SQL = """
WITH a AS (SELECT p_partkey, p_size % 25 AS blk, p_retailprice / 100.0 AS lon, p_size / 10.0 AS lat FROM part),
s AS (SELECT s_suppkey, s_name, s_nationkey AS blk, s_acctbal / 1000.0 AS s_lon, s_suppkey / 10.0 AS s_lat FROM supplier),
pairs AS (
  SELECT a.p_partkey, s.s_suppkey, s.s_name,
         (a.lon - s.s_lon) * (a.lon - s.s_lon) + (a.lat - s.s_lat) * (a.lat - s.s_lat) AS distance,
         ROW_NUMBER() OVER (PARTITION BY a.p_partkey
                            ORDER BY (a.lon - s.s_lon) * (a.lon - s.s_lon) + (a.lat - s.s_lat) * (a.lat - s.s_lat)
                                     ASC NULLS LAST, s.s_suppkey) AS rang
  FROM a JOIN s ON a.blk = s.blk)
SELECT p_partkey, s_suppkey, s_name, distance FROM pairs WHERE rang = 1
"""


@query("nearest_match", _NEAREST_SQL)
def q_nearest_match(spark, d):
    a = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 25).alias("blk"),
                                       (F.col("p_retailprice") / 100.0).alias("lon"),
                                       (F.col("p_size") / 10.0).alias("lat"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("s_blk"),
                                           (F.col("s_acctbal") / 1000.0).alias("s_lon"),
                                           (F.col("s_suppkey") / 10.0).alias("s_lat"))
    best = nearest_site(a, s, ["p_partkey"], F.col("blk"), F.col("s_blk"), ("lon", "lat"), ("s_lon", "s_lat"),
                        "distance", tie_break=["s_suppkey"])
    return best.select("p_partkey", "s_suppkey", "s_name", "distance")


# sales / stations derived from lineitem, supplier and nation for the star
# schema: an address is (part, return flag, line status) in the town of the
# supplier's nation; a station is a supplier in its nation's town.
def _star_sales(spark, d):
    li = table(spark, d, "lineitem")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.to_date("l_shipdate").alias("date_mutation"), F.col("l_extendedprice").alias("valeur_fonciere"),
        F.col("l_quantity").alias("surface_reelle_bati"), F.col("l_linenumber").alias("nombre_pieces_principales"),
        F.col("l_returnflag").alias("type_local"), F.col("l_linestatus").alias("nature_mutation"),
        F.col("s_nationkey").cast("string").alias("code_departement"),
        F.col("l_partkey").alias("adresse_numero"), F.col("l_returnflag").alias("adresse_nom_voie"),
        F.col("l_linestatus").alias("code_postal"),
        F.concat(F.col("n_name"), F.lit(" ville")).alias("nom_commune"),
        (F.col("l_discount") * 10).alias("longitude"), (F.col("l_tax") * 10).alias("latitude"),
        F.col("l_suppkey").cast("string").alias("code_commune"))


def _star_stations(spark, d):
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("libelle"), F.concat(F.col("n_name"), F.lit(" gare")).alias("commune"),
        (F.col("s_acctbal") / 10000.0).alias("longitude"), (F.col("s_suppkey") / 100.0).alias("latitude"))


# The nearest station of a place is the least (squared distance, name, lon,
# lat) among the stations whose town shares its first word; of the places of one
# address key, the one with the least such value, then lon, lat, town, code.
_STAR_SQL = """
WITH town AS (SELECT s_suppkey, s_name, s_acctbal, s_nationkey, n_name, lower(regexp_extract(n_name, '^[^ ]+')) AS word
              FROM supplier, nation WHERE n_nationkey = s_nationkey),
line AS (SELECT l.*, t.n_name, t.word, t.s_nationkey, l_discount * 10 AS x, l_tax * 10 AS y
         FROM lineitem l, town t WHERE t.s_suppkey = l.l_suppkey),
stops AS (SELECT word, list({'name': s_name, 'x': s_acctbal / 10000.0, 'y': s_suppkey / 100.0}) AS stop
          FROM town GROUP BY word),
place AS (SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, n_name, word, x, y, l_suppkey FROM line
          WHERE x + y IS NOT NULL),
scored AS (
  SELECT place.*, list_min([{'d': (x - s.x) * (x - s.x) + (y - s.y) * (y - s.y), 'name': s.name,
                             'sx': s.x, 'sy': s.y} for s in stop]) AS near
  FROM place, stops WHERE stops.word = place.word),
picked AS (
  SELECT l_partkey, l_returnflag, l_linestatus,
         min({'near': near, 'x': x, 'y': y, 'town': n_name || ' ville', 'code': CAST(l_suppkey AS VARCHAR)}) AS p
  FROM scored GROUP BY ALL),
dim AS (
  SELECT row_number() OVER (ORDER BY l_partkey, l_returnflag, l_linestatus) AS id_adresse, l_partkey AS numero,
         l_returnflag AS nom_voie, l_linestatus AS code_postal, p.town AS nom_commune, p.x AS lon, p.y AS lat,
         p.code AS code_insee, p.near.name AS nom_gare_proche, p.near.d AS distance_gare_degres
  FROM picked)
"""


@query("dim_build", _STAR_SQL + """
SELECT id_adresse, numero, nom_voie, code_postal, nom_commune, lon, lat, code_insee, nom_gare_proche,
       distance_gare_degres FROM dim
""")
def q_dim_build(spark, d):
    return address_dimension(unique_addresses(_star_sales(spark, d)), _star_stations(spark, d))


@query("fact_build", _STAR_SQL + """
SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE),
                                   l_extendedprice, l_quantity) AS id_mutation,
       id_adresse, CAST(l_shipdate AS DATE) AS date_mutation, l_extendedprice AS valeur_fonciere,
       l_quantity AS surface_reelle_bati, l_linenumber AS nombre_pieces_principales, l_returnflag AS type_local,
       l_linestatus AS nature_mutation, CAST(s_nationkey AS VARCHAR) AS code_departement
FROM line JOIN dim ON (numero, nom_voie, code_postal) = (l_partkey, l_returnflag, l_linestatus)
""")
def q_fact_build(spark, d):
    sales = _star_sales(spark, d)
    dim = address_dimension(unique_addresses(sales), _star_stations(spark, d))
    # full tie-break: rows equal on all of these are identical fact rows
    return sale_facts(sales, dim, order_cols=["l_orderkey", "adresse_numero", "l_suppkey", "nombre_pieces_principales",
                                              "date_mutation", "valeur_fonciere", "surface_reelle_bati"])


# ---------------------------------------------------------------- spatial

# Zones A-D (nested exposure levels): a square, a square with a hole, a
# two-part multipolygon and a diamond; E has an unknown geometry type and
# F none, so both are rejected by the validity check.
ZONES = [
    ("A", "Polygon", "[[[-0.05,-0.05],[0.05,-0.05],[0.05,0.05],[-0.05,0.05],[-0.05,-0.05]]]"),
    ("B", "Polygon", "[[[-0.15,-0.15],[0.15,-0.15],[0.15,0.15],[-0.15,0.15],[-0.15,-0.15]],"
                     "[[-0.02,-0.02],[0.02,-0.02],[0.02,0.02],[-0.02,0.02],[-0.02,-0.02]]]"),
    ("C", "MultiPolygon", "[[[[0.1,0.1],[0.35,0.1],[0.2,0.35],[0.1,0.1]]],"
                          "[[[-0.3,-0.3],[-0.1,-0.3],[-0.2,-0.1],[-0.3,-0.3]]]]"),
    ("D", "Polygon", "[[[0.0,-0.3],[0.3,0.0],[0.0,0.3],[-0.3,0.0],[0.0,-0.3]]]"),
    ("E", "Circle", "[0.0,0.0]"),
    ("F", None, None),
]


def _zones_frame(spark):
    rows = [(z, None if t is None else (t, c)) for z, t, c in ZONES]
    return spark.createDataFrame(rows, "zone string, geometry struct<type:string, coordinates:string>")


def _edges_sql():
    import json
    vals = []
    for z, t, c in ZONES:
        if t == "Polygon":
            rings = json.loads(c)
        elif t == "MultiPolygon":
            rings = [r for poly in json.loads(c) for r in poly]
        else:
            continue
        for ring in rings:
            for a, b in zip(ring, ring[1:]):
                vals.append(f"('{z}', {float(a[0])!r}, {float(a[1])!r}, {float(b[0])!r}, {float(b[1])!r})")
    return "(VALUES " + ", ".join(vals) + ") AS e(zone, x1, y1, x2, y2)"


@query("point_in_zone", f"""
WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py FROM embeddings),
e AS (SELECT * FROM {_edges_sql()})
SELECT vec_id, zone FROM p JOIN e ON (e.y1 > p.py) != (e.y2 > p.py)
  AND p.px < (e.x2 - e.x1) * (p.py - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY vec_id, zone HAVING COUNT(*) % 2 = 1
""")
def q_point_in_zone(spark, d):
    emb = table(spark, d, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("px"), F.col("embedding")[1].cast("double").alias("py"))
    edges = zone_edges(_zones_frame(spark), "zone")
    return points_in_zones(emb, edges, ["vec_id"], "px", "py")


# Zones of all sizes from supplier: diamonds, and squares with a square hole.
# A third of the customers live in one town on the rim of several zones.
_ZONE_SQL = """
WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 5 + (c_custkey % 1000) * 0.00001::DOUBLE
                                  ELSE (c_custkey * 0.7531::DOUBLE) % 10 END AS px,
                  CASE WHEN c_custkey % 3 = 0 THEN 5 + (c_custkey % 777) * 0.00001::DOUBLE
                       ELSE (c_custkey * 0.377::DOUBLE) % 10 END AS py FROM customer),
z AS (SELECT s_suppkey AS zone, s_suppkey % 2 = 0 AS diamond, (s_suppkey * 0.613::DOUBLE) % 10 AS x,
             (s_suppkey * 0.291::DOUBLE) % 10 AS y, 0.01::DOUBLE * (1 + s_suppkey % 9 * (s_suppkey % 50)) AS r FROM supplier),
corners AS (
  SELECT zone, CASE WHEN diamond THEN [[[x - r, y], [x, y - r], [x + r, y], [x, y + r], [x - r, y]]]
    ELSE [[[x - r, y - r], [x + r, y - r], [x + r, y + r], [x - r, y + r], [x - r, y - r]],
          [[x - r / 2, y - r / 2], [x + r / 2, y - r / 2], [x + r / 2, y + r / 2], [x - r / 2, y + r / 2], [x - r / 2, y - r / 2]]]
    END AS rings FROM z),
ring AS (SELECT zone, unnest(rings) AS c FROM corners),
e AS (SELECT zone, c[i][1] AS x1, c[i][2] AS y1, c[i + 1][1] AS x2, c[i + 1][2] AS y2
      FROM (SELECT zone, c, unnest(range(1, len(c))) AS i FROM ring))
SELECT c_custkey, zone FROM p JOIN e ON (e.y1 > p.py) != (e.y2 > p.py)
  AND p.px < (e.x2 - e.x1) * (p.py - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY c_custkey, zone HAVING COUNT(*) % 2 = 1
"""


@query("points_in_many_zones", _ZONE_SQL)
def q_points_in_many_zones(spark, d):
    k = F.col("c_custkey")
    town = lambda n: 5 + (k % n) * F.lit(0.00001)
    p = table(spark, d, "customer").select(
        "c_custkey", F.when(k % 3 == 0, town(1000)).otherwise(k * F.lit(0.7531) % 10).alias("px"),
        F.when(k % 3 == 0, town(777)).otherwise(k * F.lit(0.377) % 10).alias("py"))
    n = F.col("zone")
    z = table(spark, d, "supplier").select(F.col("s_suppkey").alias("zone")).select(
        "zone", (n * F.lit(0.613) % 10).alias("x"), (n * F.lit(0.291) % 10).alias("y"),
        (F.lit(0.01) * (1 + n % 9 * (n % 50))).alias("r"))
    ring = lambda r, corners: F.array(*[F.array(F.col("x") + a * r, F.col("y") + b * r) for a, b in corners])
    square = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    shape = F.when(n % 2 == 0, F.array(ring(F.col("r"), [(-1, 0), (0, -1), (1, 0), (0, 1), (-1, 0)]))).otherwise(
        F.array(ring(F.col("r"), square), ring(F.col("r") / 2, square)))
    zones = z.select("zone", F.struct(F.lit("Polygon").alias("type"), F.to_json(shape).alias("coordinates")).alias("geometry"))
    return points_in_zones(p, zone_edges(zones, "zone"), ["c_custkey"], "px", "py")


@query("proximity_join", """
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
pairs AS (
  SELECT a.vec_id, b.vec_id AS nb, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d
  FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id),
near AS (SELECT * FROM pairs WHERE d <= CAST(0.05 AS DOUBLE) * CAST(0.05 AS DOUBLE)),
cnt AS (SELECT vec_id, COUNT(*) AS n_within FROM near GROUP BY vec_id),
best AS (SELECT vec_id, nb, d FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d, nb) AS r FROM near) WHERE r = 1)
SELECT p.vec_id, p.label, COALESCE(cnt.n_within, 0) AS n_within, best.nb AS nearest_id, best.d AS nearest_distance
FROM p LEFT JOIN cnt ON p.vec_id = cnt.vec_id LEFT JOIN best ON p.vec_id = best.vec_id
""")
def q_proximity(spark, d):
    emb = table(spark, d, "embeddings").select(
        "vec_id", "label", F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"))
    out = proximity(emb, emb, ["vec_id"], "vec_id", "x", "y", "x", "y", radius=0.05,
                    block=[("label", "label")], exclude_same_id=True)
    return out.select("vec_id", "label", "n_within", "nearest_id", "nearest_distance")


# places up to 85 degrees of latitude and across the 180th meridian
_GLOBE = ("-180 + ({k} * 0.7531) % 360", "-85 + ({k} * 0.377) % 170")


@query("proximity_haversine", f"""
WITH p AS (SELECT c_custkey, {_GLOBE[0].format(k='c_custkey')} AS x, {_GLOBE[1].format(k='c_custkey')} AS y FROM customer),
q AS (SELECT s_suppkey, {_GLOBE[0].format(k='s_suppkey * 5')} AS x, {_GLOBE[1].format(k='s_suppkey * 5')} AS y FROM supplier),
pairs AS (
  SELECT c_custkey, s_suppkey, 2 * 6371008.8 * asin(least(1.0, sqrt(
           pow(sin(radians(q.y - p.y) / 2), 2) + cos(radians(p.y)) * cos(radians(q.y)) * pow(sin(radians(q.x - p.x) / 2), 2)
         ))) AS d
  FROM p, q)
SELECT p.c_custkey, count(s_suppkey) AS n_within, arg_min(s_suppkey, (d, s_suppkey)) AS nearest_id
FROM p LEFT JOIN pairs ON pairs.c_custkey = p.c_custkey AND d <= 500000 GROUP BY ALL
""")
def q_proximity_haversine(spark, d):
    at = lambda k: [f"{e.format(k=k).replace('0.7531', '0.7531D').replace('0.377', '0.377D')} AS {n}"
                    for e, n in zip(_GLOBE, ("x", "y"))]
    p = table(spark, d, "customer").selectExpr("c_custkey", *at("c_custkey"))
    q = table(spark, d, "supplier").selectExpr("s_suppkey", *at("s_suppkey * 5"))
    out = proximity(p, q, ["c_custkey"], "s_suppkey", "x", "y", "x", "y", radius=500_000.0, metric="haversine")
    return out.select("c_custkey", "n_within", "nearest_id")


@query("hash_id_orders", """
SELECT o_orderkey, md5(concat(ifnull(o_orderstatus, chr(31) || '-'), chr(30), ifnull(CAST(o_custkey AS VARCHAR), chr(31) || '-'),
                              chr(30))) AS id
FROM orders
""")
def q_hash_id(spark, d):
    from valora.operators.ranking import wide_hash_id
    return table(spark, d, "orders").select("o_orderkey", wide_hash_id("o_orderstatus", "o_custkey").alias("id"))


# ------------------------------------------------------------ market (D*)

@query("audit_latest_join", """
WITH latest AS (SELECT * FROM (
  SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS audit_date,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1)
SELECT c_custkey, c_name, l.o_orderkey, l.o_totalprice, l.audit_date
FROM customer LEFT JOIN latest l ON c_custkey = l.o_custkey
""")
def q_audit_latest_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice",
                                         F.to_date("o_orderdate").alias("audit_date"))
    return latest_audit_join(c, o, [F.col("c_custkey")], ["o_custkey"],
                             [F.desc_nulls_last("audit_date"), F.desc("o_orderkey")],
                             ["o_orderkey", "o_totalprice", "audit_date"])


@query("geocode_fill", """
WITH s AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
           FROM orders),
r AS (SELECT c_custkey, c_acctbal FROM (
  SELECT c_custkey, c_acctbal, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY c_acctbal DESC) AS rn
  FROM customer WHERE c_custkey IS NOT NULL) WHERE rn = 1)
SELECT o_orderkey, o_custkey,
       CASE WHEN s.o_totalprice IS NOT NULL THEN s.o_totalprice ELSE r.c_acctbal END AS o_totalprice,
       CASE WHEN s.o_totalprice IS NOT NULL THEN 'own' WHEN r.c_acctbal IS NOT NULL THEN 'reference' END
         AS coord_source
FROM s LEFT JOIN r ON s.o_custkey = r.c_custkey
""")
def q_geocode_fill(spark, d):
    s = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_custkey", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice")
    r = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return geocode_fill(s, r, [F.col("o_custkey")], [F.col("c_custkey")], {"o_totalprice": "c_acctbal"},
                        [F.desc("__ref_o_totalprice")])


_UNIT_SQL = "SELECT *, l_extendedprice / l_quantity AS unit_price FROM lineitem"


@query("outlier_fences", f"""
WITH x AS ({_UNIT_SQL}),
q AS (SELECT l_returnflag, l_linestatus, quantile_cont(unit_price, 0.25) AS q1, quantile_cont(unit_price, 0.75) AS q3
      FROM x GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence
FROM q
""")
def q_outlier_fences(spark, d):
    x = table(spark, d, "lineitem").withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    return outlier_fences(x, ["l_returnflag", "l_linestatus"], "unit_price")


@query("outlier_filter", f"""
WITH x AS ({_UNIT_SQL}),
q AS (SELECT l_returnflag, l_linestatus, quantile_cont(unit_price, 0.25) AS q1, quantile_cont(unit_price, 0.75) AS q3
      FROM x WHERE unit_price IS NOT NULL GROUP BY 1, 2)
SELECT x.l_orderkey, x.l_partkey, x.l_suppkey, x.unit_price
FROM x JOIN q ON x.l_returnflag = q.l_returnflag AND x.l_linestatus = q.l_linestatus
WHERE x.unit_price BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)
""")
def q_outlier_filter(spark, d):
    x = table(spark, d, "lineitem").withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    kept = outlier_filter(x, ["l_returnflag", "l_linestatus"], "unit_price")
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "unit_price")


def _market_frame(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "n_name", F.year("o_orderdate").alias("order_year"), "o_orderpriority",
                    "o_totalprice"))


_MARKET_SQL = """
WITH m AS (SELECT o_orderkey, n_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderpriority, o_totalprice
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


@query("price_by_location", _MARKET_SQL + """
SELECT n_name, order_year, o_orderpriority,
       CAST(GROUPING(n_name) + GROUPING(order_year) + GROUPING(o_orderpriority) AS INTEGER) AS grouping_level,
       median(o_totalprice) AS median_price, COUNT(*) AS n_sales
FROM m GROUP BY ROLLUP (n_name, order_year, o_orderpriority)
""")
def q_price_by_location(spark, d):
    return price_statistics(_market_frame(spark, d), ["n_name", "order_year", "o_orderpriority"], "o_totalprice")


@query("deal_verdict", _MARKET_SQL + """
SELECT o_orderkey, n_name, o_orderpriority, o_totalprice,
       median(o_totalprice) OVER (PARTITION BY n_name, o_orderpriority) AS local_median,
       o_totalprice / median(o_totalprice) OVER (PARTITION BY n_name, o_orderpriority) AS ratio_to_median,
       percent_rank() OVER (PARTITION BY n_name, o_orderpriority ORDER BY o_totalprice) AS price_percent_rank,
       CASE WHEN o_totalprice / median(o_totalprice) OVER (PARTITION BY n_name, o_orderpriority) < 0.9 THEN 'below'
            WHEN o_totalprice / median(o_totalprice) OVER (PARTITION BY n_name, o_orderpriority) > 1.1 THEN 'above'
            ELSE 'fair' END AS verdict
FROM m
""")
def q_deal_verdict(spark, d):
    m = _market_frame(spark, d).select("o_orderkey", "n_name", "o_orderpriority", "o_totalprice")
    return deal_verdict(m, ["n_name", "o_orderpriority"], "o_totalprice").select(
        "o_orderkey", "n_name", "o_orderpriority", "o_totalprice", "local_median", "ratio_to_median",
        "price_percent_rank", "verdict")


# --------------------------------------------------------------- flagship

@query("latest_order_median_by_priority", """
WITH latest AS (SELECT * FROM (
  SELECT o_custkey, o_orderpriority, o_totalprice,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1)
SELECT o_orderpriority, median(o_totalprice) AS median_price, COUNT(*) AS n_customers
FROM latest GROUP BY o_orderpriority
""")
def q_flagship(spark, d):
    """read -> latest row per key -> exact median per group."""
    o = table(spark, d, "orders")
    latest = latest_per_key(o, ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey")])
    return price_statistics(latest, ["o_orderpriority"], "o_totalprice", rollup=False,
                            median_alias="median_price", count_alias="n_customers").drop("grouping_level")


# ----------------------------------------- landed files derived from tables
#
# These queries land a driver table as files in the session's shared
# checkpoint folder (a fresh sub-folder per call), then read them back
# through the library's sources, so the file readers are checked on whole
# tables against the oracle.

def _landing(spark, name: str) -> str:
    import uuid
    from valora.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/landing/{name}-{uuid.uuid4().hex}"


@query("csv_union_by_name", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, c_name, CAST(NULL AS INTEGER), c_acctbal, c_mktsegment FROM customer
""")
def q_csv_union_by_name(spark, d):
    from valora.sources.delimited import read_delimited_by_header
    c = table(spark, d, "customer")
    root = _landing(spark, "customers")
    # two landed copies of the whole table with different column sets/orders
    c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").write.option("header", True).option("sep", ";") \
        .csv(f"{root}/adresses-a")
    c.select("c_mktsegment", "c_acctbal", "c_custkey", "c_name").write.option("header", True).option("sep", ";") \
        .csv(f"{root}/adresses-b")
    out = read_delimited_by_header(spark, f"{root}/*", ";", "part-*.csv",
                                   types={"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})
    return out.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("pipe_gzip_scan", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate, CAST(NULL AS VARCHAR) AS l_comment
FROM lineitem
""")
def q_pipe_gzip_scan(spark, d):
    from valora.sources.delimited import read_delimited
    li = table(spark, d, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    root = _landing(spark, "lineitem")
    li.write.option("header", True).option("sep", "|").option("compression", "gzip").csv(root)
    cols = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
            ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
            ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "date")]
    # all-text scan with a keep-list (one wanted column is absent), then
    # typed by the declared schema; gzip is one split per file, so the read
    # is repartitioned
    raw = read_delimited(spark, root, sep="|", all_text=True, partitions=spark.sparkContext.defaultParallelism)
    kept, _missing = reconcile(raw, [c for c, _ in cols] + ["l_comment"])
    return kept.select(*[F.col(c).try_cast(t).alias(c) for c, t in cols], "l_comment")


@query("stream_latest_orders", """
SELECT CAST(o_custkey AS VARCHAR) AS numero_dpe,
       MAX(CAST(o_orderdate AS DATE)) AS date_derniere_modification_dpe,
       ARG_MAX(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), (CAST(o_orderdate AS DATE), lpad(CAST(o_orderkey AS VARCHAR), 12, '0'))) AS code_insee_ban,
       ARG_MAX(o_orderstatus, (CAST(o_orderdate AS DATE), lpad(CAST(o_orderkey AS VARCHAR), 12, '0'))) AS etiquette_dpe,
       CAST(0.0 AS DOUBLE) AS score_ban, 0 AS indicateur_confort_ete
FROM orders GROUP BY o_custkey
""")
def q_stream_latest_orders(spark, d):
    """Orders landed as JSON pages (one page per line, 500 records each) and
    run through the incremental latest-version query until the landing is
    drained; the state snapshot is read back."""
    from valora import schemas
    from valora.streaming.audit_stream import start_latest_versions
    o = table(spark, d, "orders")
    root = _landing(spark, "order-pages")
    recs = o.select(
        (F.col("o_orderkey") % F.lit(1 << 62)).alias("__k"),
        F.struct(F.col("o_custkey").cast("string").alias("numero_dpe"),
                 F.to_date("o_orderdate").cast("string").alias("date_etablissement_dpe"),
                 F.to_date("o_orderdate").cast("string").alias("date_derniere_modification_dpe"),
                 F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("code_insee_ban"),
                 F.col("o_orderstatus").alias("etiquette_dpe")).alias("r"))
    pages = (recs.groupBy(F.floor(F.col("__k") / 500).alias("page"))
             .agg(F.count(F.lit(1)).alias("total"), F.collect_list("r").alias("results")))
    pages.write.json(f"{root}/in")
    q = start_latest_versions(spark, f"{root}/in", schemas.AUDIT_API_TEXT, f"{root}/ckpt",
                              sink_table=f"{root}/state", trigger_once=True, multiline=False, snapshot=True)
    q.awaitTermination()
    st = spark.read.parquet(f"{root}/state")
    return st.select("numero_dpe", "date_derniere_modification_dpe", "code_insee_ban", "etiquette_dpe",
                     "score_ban", "indicateur_confort_ete")


@query("audit_lost_values", f"""
WITH raw AS (SELECT {_audit_raw_sql()} FROM events)
SELECT * FROM (
  SELECT 'unparsable_conso_5_usages_ep' AS check_name,
         COUNT(*) FILTER (WHERE TRIM(conso_5_usages_ep) != ''
           AND TRY_CAST(REPLACE(REPLACE(conso_5_usages_ep, ',', '.'), ' ', '') AS DOUBLE) IS NULL) AS n FROM raw
  UNION ALL
  SELECT 'unparsable_cout_total_5_usages',
         COUNT(*) FILTER (WHERE TRIM(cout_total_5_usages) != ''
           AND TRY_CAST(REPLACE(REPLACE(cout_total_5_usages, ',', '.'), ' ', '') AS DOUBLE) IS NULL) FROM raw
  UNION ALL
  SELECT 'unparsable_indicateur_confort_ete',
         COUNT(*) FILTER (WHERE TRIM(indicateur_confort_ete) != ''
           AND TRY_CAST(indicateur_confort_ete AS INTEGER) IS NULL) FROM raw)
""")
def q_audit_lost_values(spark, d):
    """Values the audit clean-up replaces without trace."""
    from valora.operators.quality import parse_failures
    spec = AuditSpec()
    return parse_failures(_audit_raw(spark, d), spec.measures, [c for c, _ in spec.int_default])
