"""The full build (the reference's main script), as one Spark job graph.

Landed inputs -> cleaned tables written under ``out_dir``:

* ``adresses``: all address files, union by name, rejects counted  (S1)
* ``dvf``: sales, year range + price filter + fills  (S2 + C1)
* ``gares``: station pages  (C14)
* ``zones``: noise-zone attributes; geometries kept for exposure  (C15)
* ``dpe_final``: audits, keep-list, imputation, latest version  (S4+S5+C6+C7)
* ``dim_adresses`` / ``fact_dvf``: star schema  (C10-C12)
* ``ventes``: one row a sale (D5) with coordinates filled from addresses, and the
  noise zone, stations, schools and audit of each, as far as these are landed  (D1-D4)
* ``prix`` / ``verdicts``: prices by place and kind, sales against them  (D6-D8)
* ``adresses_rejected``, ``dvf_rejected``, ``zones_rejected``, ``dvf_missing_columns``,
  ``dpe_missing_columns``: what was left out

Every step is a lazy DataFrame until its table is written; medians come
from one aggregation joined back by broadcast, nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valora import schemas
from valora.functions import year_in
from valora.operators.clean import AuditSpec, clean_audits, clean_sales, fill_numeric
from valora.operators.dedup import group_transactions, latest_per_key
from valora.operators.ranking import stable
from valora.operators.star import address_dimension, sale_facts, unique_addresses
from valora.plans import market_build
from valora.sinks import write_table
from valora.sources.delimited import read_delimited, read_delimited_by_header, typed_field
from valora.sources.geojson import ZONE_PROPERTIES, read_features, split_zones
from valora.sources.json_pages import SCHOOL_RECORD, read_points, stations_table
from valora.sources.reconcile import reconcile


COORDINATES = ["longitude", "latitude"]


@dataclass
class Landing:
    addresses: str | None = None      # folder of ';' CSV files (any headers)
    address_glob: str | None = "adresses-*.csv*"
    sales: str | None = None          # ',' CSV, optionally .gz
    stations: str | None = None       # folder of JSON pages
    zones: str | None = None          # GeoJSON file
    audits: str | None = None         # ',' CSV, all text
    schools: str | None = None        # JSON list of records with longitude and latitude


def parse_sales(spark: SparkSession, path: str, years=(2024, 2025), partitions: int | None = None,
                multi_line: bool = False) -> tuple[DataFrame, list[str]]:
    """The wanted columns by name, whatever else the file has and in any order
    (absent ones as NULL, and reported), cast by the declared schema, and ``__good``: false for rows
    with a field that does not cast, or too many or too few fields.  Good rows of other years or
    without a price are left out here, so what is kept of a national file is small."""
    raw = read_delimited(spark, path, sep=",", schema=None, all_text=True, partitions=partitions, multi_line=multi_line,
                         flag="__good")
    kept, missing = reconcile(raw, [*schemas.SALES.fieldNames(), "__good"])
    typed = {f.name: typed_field(F.col(f.name), f.dataType) for f in schemas.SALES.fields}
    fine = F.col("__good")
    for name, value in typed.items():
        fine = fine & (F.col(name).isNull() | value.isNotNull())
    rows = kept.select(*(c.alias(n) for n, c in typed.items()), fine.alias("__good"))
    wanted = year_in(rows, "date_mutation", years) & F.col("valeur_fonciere").isNotNull()
    return rows.where(~F.col("__good") | wanted), missing


def good_sales(parsed: DataFrame, years=(2024, 2025)) -> DataFrame:
    """The good rows of ``parse_sales``, filled (C1); missing coordinates stay NULL."""
    return clean_sales(parsed.where("__good").drop("__good"), years=years, fill_coordinates=False)


def load_sales(spark: SparkSession, path: str, years=(2024, 2025), partitions: int | None = None,
               multi_line: bool = False, fill_coordinates: bool = True) -> DataFrame:
    """Sales from a file, missing coordinates filled with 0 as the reference does."""
    sales = good_sales(parse_sales(spark, path, years, partitions, multi_line)[0], years)
    return fill_numeric(sales, COORDINATES, 0) if fill_coordinates else sales


def load_audits(spark: SparkSession, path: str, spec: AuditSpec | None = None) -> tuple[DataFrame, list[str]]:
    """Audit file -> keep-list (missing columns reported, typed NULL) ->
    one-projection clean-up -> latest version per audit number."""
    raw = read_delimited(spark, path, sep=",", schema=None, all_text=True)
    kept, missing = reconcile(raw, schemas.AUDIT_COLUMNS)
    return dedup_audits(clean_audits(kept, spec)), missing


def dedup_audits(cleaned: DataFrame, spec: AuditSpec | None = None) -> DataFrame:
    """Latest modification per audit number, NULL dates last, ties broken
    by the other dates (the reference leaves ties arbitrary, Q2)  (C7)."""
    s = spec or AuditSpec()
    have = set(cleaned.columns)
    dates = [c for c in [s.modified, *s.dates] if c in have]
    order = [F.desc_nulls_last(c) for c in dict.fromkeys(dates)] + [F.xxhash64(*cleaned.columns)]
    return latest_per_key(cleaned, [s.key], order)


def run(spark: SparkSession, landing: Landing, out_dir: str, years=(2024, 2025)) -> dict[str, str]:
    """Build every table whose input is landed; return table -> path."""
    written: dict[str, str] = {}

    def put(name: str, df: DataFrame, **kw):
        path = f"{out_dir}/{name}"
        write_table(df, path, **kw)
        written[name] = path

    if landing.addresses:
        good, bad = read_delimited_by_header(spark, landing.addresses, ";", landing.address_glob,
                                             types=schemas.ADDRESS_TYPES, keep_rejects=True)
        put("adresses", good)
        put("adresses_rejected", bad.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rejected")))
    sales = None
    if landing.sales:
        # the file is read once; what follows reads the parsed table
        flagged, missing = parse_sales(spark, landing.sales, years)
        flagged = stable(flagged)
        put("dvf_rejected", flagged.agg(F.count_if(~F.col("__good")).alias("n_rejected")))
        parsed = good_sales(flagged, years)
        put("dvf_missing_columns", spark.createDataFrame([(c,) for c in missing], "column string"))
        put("dvf", fill_numeric(parsed, COORDINATES, 0))
        sales = spark.read.parquet(written["dvf"])
    stations = None
    if landing.stations:
        put("gares", stations_table(spark, landing.stations))
        stations = spark.read.parquet(written["gares"])
    if landing.zones:
        # read once, as the sales are
        attrs, geoms, rejected = split_zones(stable(read_features(spark, landing.zones, ZONE_PROPERTIES)))
        put("zones_rejected", rejected)
        put("zones", attrs)
        put("zones_geometry", geoms)
    if landing.audits:
        audits, missing = load_audits(spark, landing.audits)
        put("dpe_missing_columns", spark.createDataFrame([(c,) for c in missing], "column string"))
        put("dpe_final", audits)
    if sales is not None and stations is not None:
        dim = address_dimension(unique_addresses(sales), stations)
        put("dim_adresses", dim)
        dim = spark.read.parquet(written["dim_adresses"])
        put("fact_dvf", sale_facts(sales, dim))
    if landing.sales:
        table = {name: spark.read.parquet(path) for name, path in written.items()}
        # one row a sale: its parcels are rows that agree in every column kept.
        # Each step reads its sales several times (places, frequent keys), so it starts from a written table
        steps = [lambda rich: group_transactions(rich, parsed.columns)]
        if "adresses" in table:
            steps.append(lambda rich: market_build.with_coordinates(rich, table["adresses"]))
        if "zones_geometry" in table:
            steps.append(lambda rich: market_build.with_zone(rich, table["zones_geometry"]))
        if "gares" in table:
            steps.append(lambda rich: market_build.with_stations(rich, table["gares"]))
        if landing.schools:
            schools = stable(read_points(spark, landing.schools, SCHOOL_RECORD))
            steps.append(lambda rich: market_build.with_schools(rich, schools, "identifiant"))
        if "dpe_final" in table:
            steps.append(lambda rich: market_build.with_audit(rich, table["dpe_final"]))
        rich = parsed
        for step in steps[:-1]:
            rich = stable(step(rich))
        rich = steps[-1](rich)
        put("ventes", rich)
        rich = spark.read.parquet(written["ventes"])
        put("prix", market_build.prices(rich))
        put("verdicts", market_build.verdicts(rich))
    return written


def main(argv: list[str] | None = None) -> None:
    """``python -m valora.plans.build --sales ... --out ...`` (or spark-submit
    with the package on --py-files): the
    cluster manager supplies the master; the output folder should be on the
    shared file system."""
    import argparse
    from valora.session import get_session

    ap = argparse.ArgumentParser(description="Build the property-market tables from landed files.")
    ap.add_argument("--out", required=True)
    ap.add_argument("--addresses")
    ap.add_argument("--sales")
    ap.add_argument("--stations")
    ap.add_argument("--zones")
    ap.add_argument("--audits")
    ap.add_argument("--schools")
    ap.add_argument("--years", default="2024,2025")
    a = ap.parse_args(argv)
    spark = get_session(app_name="valora-build")
    written = run(spark, Landing(addresses=a.addresses, sales=a.sales, stations=a.stations, zones=a.zones,
                                 audits=a.audits, schools=a.schools), a.out, years=tuple(int(y) for y in a.years.split(",")))
    for name, path in written.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
