"""Cleaning: fills, not-null filters, median imputation, audit projection
(P7, P8, F1, F2, C1-C6)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valora.functions import (
    NOT_PROVIDED, UNKNOWN, first_non_blank, is_non_blank, parse_fr_number, try_double,
    try_int_rounded, upper_trim, with_default, with_sentinel, year_in,
)
from valora.operators.ranking import exact_quantiles
from valora.operators.sizing import attach_one_row


def fill_numeric(df: DataFrame, cols: list[str], value=0) -> DataFrame:
    """NULL -> 0 over a column list, one projection  (P7)."""
    present = [c for c in cols if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def fill_text(df: DataFrame, cols: list[str], value: str = NOT_PROVIDED) -> DataFrame:
    """NULL -> 'NR' over a column list  (P8)."""
    present = [c for c in cols if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """WHERE c IS NOT NULL for each column  (F1)."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


# ---------------------------------------------------------------- sales

# The sales columns the reference fills with 0 / with 'NR'.
SALES_NUMERIC_FILL = ["surface_reelle_bati", "nombre_pieces_principales", "longitude", "latitude",
                      "adresse_numero"]
SALES_TEXT_FILL = ["type_local", "adresse_code_voie", "adresse_nom_voie", "adresse_suffixe",
                   "code_postal"]


def clean_sales(df: DataFrame, years=(2024, 2025), date_col: str = "date_mutation",
                price_col: str = "valeur_fonciere", fill_coordinates: bool = True) -> DataFrame:
    """Year range filter -> price not null -> fills  (C1).

    ``fill_coordinates=True`` reproduces the reference (missing coordinates
    become (0, 0)); ``False`` leaves them NULL so later distance work skips
    them (SURVEY Q7)."""
    out = df.where(year_in(df, date_col, years)).where(F.col(price_col).isNotNull())
    numeric = SALES_NUMERIC_FILL if fill_coordinates else \
        [c for c in SALES_NUMERIC_FILL if c not in ("longitude", "latitude")]
    return fill_text(fill_numeric(out, numeric, 0), SALES_TEXT_FILL, NOT_PROVIDED)


# ------------------------------------------------------- median impute

def column_medians(df: DataFrame, cols: list[str], parse=parse_fr_number) -> DataFrame:
    """One-row frame of exact medians of ``parse(col)`` over non-blank text,
    0 where a column has no parsable value — all columns in one set of
    passes (the reference runs one query per column)."""
    parsed = df.select(*[F.when(is_non_blank(F.col(c)), parse(F.col(c))).alias(c) for c in cols])
    med = exact_quantiles(parsed, [], cols, {"median": 0.5}, name_fmt="{col}")
    return med.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(f"__median_{c}") for c in cols])


def impute_median(df: DataFrame, cols: list[str], parse=parse_fr_number) -> DataFrame:
    """COALESCE(parse(c), median(c)) for each column  (C2).

    The medians are a one-row frame joined by broadcast (one row is a proven
    bound), so they never pass through the driver as literals."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    med = column_medians(df, present, parse)
    out = attach_one_row(df, med)
    for c in present:
        out = out.withColumn(c, F.coalesce(parse(F.col(c)), F.col(f"__median_{c}")))
    return out.drop(*[f"__median_{c}" for c in present])


# ------------------------------------------------------------ audits

@dataclass
class AuditSpec:
    """Which audit columns get which rule.  Defaults are the reference's
    file variant; the API variant lacks three measures (``present`` columns
    are intersected with the frame, SURVEY S5/Q12)."""

    # The reference's audit column groups.
    key: str = "numero_dpe"
    modified: str = "date_derniere_modification_dpe"
    dates: list = field(default_factory=lambda: [
        "date_etablissement_dpe", "date_fin_validite_dpe", "date_derniere_modification_dpe"])
    codes: list = field(default_factory=lambda: [
        "code_insee_ban", "code_departement_ban", "code_region_ban"])
    fallbacks: list = field(default_factory=lambda: [
        ("nom_commune_ban", "nom_commune_brut"), ("code_postal_ban", "code_postal_brut")])
    coords: list = field(default_factory=lambda: [
        "coordonnee_cartographique_x_ban", "coordonnee_cartographique_y_ban"])
    coord_sentinel: float = -999.0
    score: str = "score_ban"
    score_sentinel: float = 0.0
    raw_text_empty: list = field(default_factory=lambda: ["adresse_brut", "nom_commune_brut"])
    raw_text_keep: list = field(default_factory=lambda: ["code_postal_brut"])
    labels: list = field(default_factory=lambda: ["etiquette_dpe", "etiquette_ges"])
    measures: list = field(default_factory=lambda: [
        "conso_5_usages_ep", "conso_5_usages_par_m2_ep",
        "conso_5 usages_ef", "conso_5 usages_par_m2_ef",
        "emission_ges_5_usages", "emission_ges_5_usages par_m2",
        "cout_total_5_usages", "cout_chauffage", "cout_ecs",
        "cout_refroidissement", "cout_eclairage", "cout_auxiliaires",
        "surface_habitable_logement", "nombre_niveau_logement", "conso_chauffage_ef"])
    categories: list = field(default_factory=lambda: [
        "zone_climatique", "classe_altitude", "qualite_isolation_murs",
        "type_generateur_chauffage_principal", "typologie_logement"])
    unchanged: list = field(default_factory=lambda: [
        "periode_construction", "type_batiment", "type_energie_principale_chauffage",
        "qualite_isolation_enveloppe", "qualite_isolation_menuiseries", "ubat_w_par_m2_k"])
    int_default: list = field(default_factory=lambda: [("indicateur_confort_ete", 0)])
    text_unknown: list = field(default_factory=lambda: [("isolation_toiture", UNKNOWN)])
    cast_dates: bool = True


def clean_audits(df: DataFrame, spec: AuditSpec | None = None) -> DataFrame:
    """The whole audit clean-up in one projection  (C6 = C2+C3+C4+C5+X4+X9).

    Dates are cast to DATE once (``cast_dates``) so later ordering and
    comparisons are on dates, not text (SURVEY Q10)."""
    s = spec or AuditSpec()
    have = set(df.columns)
    measures = [c for c in s.measures if c in have]
    base = df
    if measures:
        med = column_medians(df, measures)
        base = attach_one_row(df, med)

    sel: list[Column] = []
    if s.key in have:
        sel.append(F.nullif(F.col(s.key), F.lit("")).alias(s.key) if dict(df.dtypes)[s.key] == "string"
                   else F.col(s.key))
    for c in s.dates:
        if c in have:
            sel.append(F.col(c).try_cast("date").alias(c) if s.cast_dates else F.col(c))
    for c in s.codes:
        if c in have:
            sel.append(with_default(F.col(c)).alias(c))
    for primary, fallback in s.fallbacks:
        cols = [F.col(x) for x in (primary, fallback) if x in have]
        if cols:
            sel.append(first_non_blank(*cols).alias(primary))
    for c in s.coords:
        if c in have:
            sel.append(with_sentinel(try_double(F.col(c)), s.coord_sentinel).alias(c))
    if s.score in have:
        sel.append(with_sentinel(try_double(F.col(s.score)), s.score_sentinel).alias(s.score))
    for c in s.raw_text_empty:
        if c in have:
            sel.append(F.coalesce(F.col(c), F.lit("")).alias(c))
    for c in s.raw_text_keep:
        if c in have:
            sel.append(F.col(c))
    for c in s.labels:
        if c in have:
            sel.append(upper_trim(F.col(c)).alias(c))
    for c in measures:
        sel.append(F.coalesce(parse_fr_number(F.col(c)), F.col(f"__median_{c}")).alias(c))
    for c in s.categories:
        if c in have:
            sel.append(with_default(F.col(c)).alias(c))
    for c in s.unchanged:
        if c in have:
            sel.append(F.col(c))
    for c, d in s.int_default:
        if c in have:
            sel.append(F.coalesce(try_int_rounded(F.col(c)), F.lit(d)).alias(c))
    for c, d in s.text_unknown:
        if c in have:
            sel.append(with_default(F.col(c), d).alias(c))
    return base.select(*sel)
