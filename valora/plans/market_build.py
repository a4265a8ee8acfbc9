"""The joins the build adds to the sales: coordinates, noise zone, schools,
audit (D1-D4); and the tables computed from them: prices and verdicts (D5-D8).

Places are looked up once per distinct pair of coordinates and joined back, so
sales without coordinates, which stay NULL here, take no part in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.functions import NOT_PROVIDED, lower_key
from valora.functions.address import parse_address, street_key, suffix_key
from valora.operators.address import match_addresses
from valora.operators.market import deal_verdict, geocode_fill, outlier_filter, price_statistics
from valora.operators.skew import skew_join
from valora.operators.spatial import first_zone, points_in_zones, proximity, zone_edges

# Noise zones from the most to the least exposed.
ZONE_ORDER = ["A", "B", "C", "D"]
#: Radius (metres) within which schools are counted.
SCHOOL_RADIUS_M = 1000.0
#: Radius (metres) within which stations are counted.
STATION_RADIUS_M = 10_000.0
PLACE = ["longitude", "latitude"]


def with_coordinates(sales: DataFrame, addresses: DataFrame) -> DataFrame:
    """Missing coordinates from the official address with the same number,
    street (whatever its case) and postcode  (D4); of several the smallest."""
    return geocode_fill(
        sales, addresses, [F.col("adresse_numero"), lower_key(F.col("adresse_nom_voie")), F.col("code_postal")],
        [F.col("numero"), lower_key(F.col("nom_voie")), F.col("code_postal")],
        {"longitude": "lon", "latitude": "lat"}, [F.asc_nulls_last("__ref_longitude"), F.asc_nulls_last("__ref_latitude")])


def _places(sales: DataFrame) -> DataFrame:
    return sales.select(*PLACE).where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).distinct()


def with_zone(sales: DataFrame, zones: DataFrame, zone_col: str = "ZONE") -> DataFrame:
    """``zone_bruit``: the most exposed noise zone of the sale's place  (D1)."""
    places = _places(sales)
    inside = points_in_zones(places, zone_edges(zones, zone_col), PLACE, *PLACE)
    return skew_join(sales, first_zone(places, inside, PLACE, ZONE_ORDER, "zone_bruit"), PLACE, "left")


def with_schools(sales: DataFrame, schools: DataFrame, school_id: str) -> DataFrame:
    """Schools within reach, the nearest of them and its distance  (D2)."""
    near = proximity(_places(sales), schools, PLACE, school_id, *PLACE, "longitude", "latitude", SCHOOL_RADIUS_M,
                     "haversine", count_alias="n_ecoles", nearest_alias="ecole_proche",
                     distance_alias="distance_ecole_m")
    return skew_join(sales, near, PLACE, "left")


def with_stations(sales: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations within reach, the nearest of them and its distance  (D2), whatever
    town they are listed under."""
    near = proximity(_places(sales), stations, PLACE, "code_uic", *PLACE, "longitude", "latitude", STATION_RADIUS_M,
                     "haversine", count_alias="n_gares", nearest_alias="gare_proche", distance_alias="distance_gare_m")
    return skew_join(sales, near, PLACE, "left")


def with_audit(sales: DataFrame, audits: DataFrame) -> DataFrame:
    """Latest audit at the sale's address in its commune  (D3): by the
    normalised number, suffix and street, or else the most similar street at that number."""
    provided = lambda c: F.when(F.col(c) != NOT_PROVIDED, F.col(c))
    raw = parse_address(F.col("adresse_brut"))
    return match_addresses(
        sales, audits.select("*", raw.alias("__raw")),
        {"commune": F.col("code_commune"), "number": F.col("adresse_numero"), "suffix": suffix_key(provided("adresse_suffixe")),
         "street": street_key(provided("adresse_nom_voie"))},
        {"commune": F.nullif(F.col("code_insee_ban"), F.lit(NOT_PROVIDED)), "number": F.col("__raw.number"),
         "suffix": F.col("__raw.suffix"), "street": F.col("__raw.street")},
        [F.desc_nulls_last("date_derniere_modification_dpe"), F.desc("numero_dpe")],
        ["numero_dpe", "etiquette_dpe", "etiquette_ges"], how_alias="dpe_match")


def unit_prices(sales: DataFrame) -> DataFrame:
    """Sales with a surface, their price a square metre, outliers of their
    department and kind left out  (D6)."""
    priced = sales.where(F.col("surface_reelle_bati") > 0).withColumn(
        "prix_m2", F.col("valeur_fonciere") / F.col("surface_reelle_bati"))
    return outlier_filter(priced, ["code_departement", "type_local"], "prix_m2")


def prices(sales: DataFrame) -> DataFrame:
    """Median price a square metre by department, town and kind  (D7)."""
    return price_statistics(unit_prices(sales), ["code_departement", "nom_commune", "type_local"], "prix_m2")


def verdicts(sales: DataFrame) -> DataFrame:
    """Each priced sale against its town and kind  (D8)."""
    return deal_verdict(unit_prices(sales), ["code_departement", "nom_commune", "type_local"], "prix_m2")
