"""Declared schemas of the landed sources (no schema inference).

Postal and municipality codes are text (leading zeros, '2A004').
"""

from __future__ import annotations

from pyspark.sql import types as T

# The sales file columns the reference keeps, in its order.
SALES_COLUMNS = [
    ("date_mutation", "date"), ("valeur_fonciere", "double"), ("surface_reelle_bati", "double"),
    ("adresse_numero", "bigint"), ("adresse_suffixe", "string"), ("adresse_code_voie", "string"),
    ("adresse_nom_voie", "string"), ("nombre_pieces_principales", "int"), ("type_local", "string"),
    ("nature_mutation", "string"), ("longitude", "double"), ("latitude", "double"),
    ("code_commune", "string"), ("code_postal", "string"), ("nom_commune", "string"),
    ("code_departement", "string"),
]

# The audit columns the reference keeps (file variant).
AUDIT_COLUMNS = [
    "numero_dpe", "date_etablissement_dpe", "date_fin_validite_dpe", "date_derniere_modification_dpe",
    "code_insee_ban", "code_departement_ban", "code_region_ban",
    "coordonnee_cartographique_x_ban", "coordonnee_cartographique_y_ban", "score_ban",
    "nom_commune_ban", "code_postal_ban", "adresse_brut", "nom_commune_brut", "code_postal_brut",
    "etiquette_dpe", "etiquette_ges",
    "conso_5_usages_ep", "conso_5_usages_par_m2_ep",
    "conso_5 usages_ef", "conso_5 usages_par_m2_ef",
    "emission_ges_5_usages", "emission_ges_5_usages par_m2",
    "cout_total_5_usages", "cout_chauffage", "cout_ecs",
    "cout_refroidissement", "cout_eclairage", "cout_auxiliaires",
    "type_batiment", "typologie_logement", "surface_habitable_logement",
    "periode_construction", "indicateur_confort_ete",
    "nombre_niveau_logement", "zone_climatique", "classe_altitude",
    "type_energie_principale_chauffage", "type_generateur_chauffage_principal",
    "qualite_isolation_enveloppe", "qualite_isolation_murs",
    "qualite_isolation_menuiseries", "ubat_w_par_m2_k", "isolation_toiture", "conso_chauffage_ef",
]

# Fixed value: the three measures the API variant does not serve.
AUDIT_API_ABSENT = ["conso_5 usages_ef", "conso_5 usages_par_m2_ef", "emission_ges_5_usages par_m2"]

# The pipe-delimited raw sales file columns used in exploration.
SALES_RAW_PIPE_COLUMNS = [
    "Valeur fonciere", "Surface reelle bati", "Nombre pieces principales", "Type local", "Nature mutation",
    "Code commune", "Date mutation", "Code postal", "Commune", "Code departement", "Code voie", "Voie",
]


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "date": T.DateType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def data_type(name: str) -> T.DataType:
    return _TYPES[name]


def struct(cols: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, data_type(t), True) for n, t in cols])


def all_text(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


SALES = struct(SALES_COLUMNS)
AUDIT_TEXT = all_text(AUDIT_COLUMNS)
AUDIT_API_TEXT = all_text([c for c in AUDIT_COLUMNS if c not in AUDIT_API_ABSENT])

# Address (BAN) columns used downstream; other file columns are kept as text.
ADDRESS_TYPES = {"numero": "bigint", "lon": "double", "lat": "double"}
