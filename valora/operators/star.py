"""Star schema: address dimension with nearest station, sales fact
(C10-C13, W3, J1, J5, P3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.functions import NOT_PROVIDED, first_word_key, haversine_m, lower_key
from valora.operators.joins import normalised_key_join, prefix_columns
from valora.operators.nearest import nearest_site
from valora.operators.ranking import dense_id, hash_id, stable
from valora.operators.skew import skew_join

ADDRESS_KEY = ["numero", "nom_voie", "code_postal"]
SALE_KEY = ["adresse_numero", "adresse_nom_voie", "code_postal"]
#: Address key of the sales whose address is missing (the fills' values).
FILL_KEY = (0, NOT_PROVIDED, NOT_PROVIDED)


def unique_addresses(sales: DataFrame, exclude_sentinel_keys: bool = False) -> DataFrame:
    """Distinct addresses that have at least one sale, with coordinates
    (C10, A8).  Done before any distance work so each address is ranked once.

    ``exclude_sentinel_keys`` drops addresses whose street or postcode is the
    'NR' fill value, which would otherwise merge unrelated sales into one
    address (SURVEY Q8); off by default to match the reference."""
    out = sales.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    if exclude_sentinel_keys:
        out = out.where((F.col("adresse_nom_voie") != NOT_PROVIDED) & (F.col("code_postal") != NOT_PROVIDED))
    return out.select(
        F.col("adresse_numero").alias("numero"), F.col("adresse_nom_voie").alias("nom_voie"),
        "code_postal", "nom_commune", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"),
        F.col("code_commune").alias("code_insee")).distinct()


def address_dimension(addresses: DataFrame, stations: DataFrame, how: str = "inner",
                      id_mode: str = "dense", with_metres: bool = False) -> DataFrame:
    """Nearest station per address key by squared planar distance inside the
    first-word-of-town block, then a surrogate id  (C11 = J3 + J4 + W3 + P3).

    The reference numbers rows before keeping rank 1 (ids with gaps, Q3);
    here the id is assigned after: ``dense`` = 1..n in address-key order,
    ``hash`` = 64-bit hash of the key (no ordering pass).  ``with_metres``
    adds ``distance_gare_m``, the great-circle distance, next to the
    reference's squared degrees (SURVEY Q5)."""
    st = stations.select(F.col("libelle").alias("nom_gare_proche"), F.col("commune").alias("__s_commune"),
                         F.col("longitude").alias("__s_lon"), F.col("latitude").alias("__s_lat"))
    best = nearest_site(
        stable(addresses), st, ADDRESS_KEY,
        left_block=first_word_key(F.col("nom_commune")), right_block=first_word_key(F.col("__s_commune")),
        left_xy=("lon", "lat"), right_xy=("__s_lon", "__s_lat"), distance_alias="distance_gare_degres", tie_break=["nom_gare_proche", "__s_lon", "__s_lat",
                                                          "lon", "lat", "nom_commune", "code_insee"],
        how=how)
    cols = ["numero", "nom_voie", "code_postal", "nom_commune", "lon", "lat", "code_insee",
            "nom_gare_proche", "distance_gare_degres"]
    if with_metres:
        best = best.withColumn("distance_gare_m", haversine_m(F.col("lon"), F.col("lat"),
                                                               F.col("__s_lon"), F.col("__s_lat")))
        cols.append("distance_gare_m")
    best = best.drop("__s_commune", "__s_lon", "__s_lat")
    if id_mode == "hash":
        return best.select(hash_id(*ADDRESS_KEY).alias("id_adresse"), *cols)
    return dense_id(best.select(*cols), ADDRESS_KEY, "id_adresse").select("id_adresse", *cols)


def sale_facts(sales: DataFrame, dim: DataFrame, how: str = "inner",
               order_cols: list[str] | None = None) -> DataFrame:
    """Sales joined to the address dimension on the 3-column key, keeping
    the dimension id, then a surrogate ``id_mutation``  (C12 = J1 + J5 + W3).
    ``how='inner'`` drops sales whose address has no dimension row, as the
    reference does; ``'left'`` keeps them with a NULL id.  Sales without an
    address share the fill key; they, those of any other key that very many
    share, and NULL keys are spread."""
    j = skew_join(sales, dim.select("id_adresse", *[F.col(k).alias(c) for k, c in zip(ADDRESS_KEY, SALE_KEY)]), SALE_KEY, how)
    fact_cols = ["id_adresse", "date_mutation", "valeur_fonciere", "surface_reelle_bati",
                 "nombre_pieces_principales", "type_local", "nature_mutation", "code_departement"]
    order = order_cols or ["date_mutation", "adresse_numero", "adresse_nom_voie", "code_postal",
                           "valeur_fonciere", "surface_reelle_bati", "type_local"]
    out = dense_id(j, order, "id_mutation", keep=fact_cols)
    return out.select("id_mutation", *fact_cols)


def sales_address_view(sales: DataFrame, addresses: DataFrame) -> DataFrame:
    """Draft view: every sales column plus every official address column,
    joined on number, lower-cased street and postcode  (C13 = J2 + P5).
    Address columns are prefixed ``adr_`` where the reference's engine
    would have renamed clashes to ``_1``."""
    adr = prefix_columns(addresses, "adr_")
    out = normalised_key_join(
        sales.withColumn("adresse_nom_voie_clean", lower_key(F.col("adresse_nom_voie"))), adr,
        [F.col("adresse_numero"), lower_key(F.col("adresse_nom_voie")), F.col("code_postal")],
        [F.col("adr_numero"), lower_key(F.col("adr_nom_voie")), F.col("adr_code_postal")])
    return out.withColumn("adresses_nom_voie_officiel", F.col("adr_nom_voie"))
