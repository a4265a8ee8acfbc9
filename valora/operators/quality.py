"""Declarative quality checks -> one aggregation -> long report
(C9, A4, A5, A9, A3, O1, O2, F6-F11).

The reference runs one COUNT query per check.  Here a check is a named
predicate; all row-level checks are evaluated in one ``agg`` of
``count_if``s, duplicate keys in one ``groupBy`` (partial + final hash
aggregate), and the counts are stacked into a (check, n) frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valora.functions import domain_violation, ends_before_start, expired, upper_trim


@dataclass(frozen=True)
class Check:
    name: str
    predicate: Column
    logged: bool = True   # info-only checks (e.g. expired audits) are not logged


# Fixed value: the valid energy / greenhouse labels.
VALID_LABELS = ("A", "B", "C", "D", "E", "F", "G")


def audit_checks(key: str = "numero_dpe", label_cols=("etiquette_dpe", "etiquette_ges"),
                 start: str = "date_etablissement_dpe", end: str = "date_fin_validite_dpe",
                 surface: str = "surface_habitable_logement", consumption: str = "conso_5_usages_ep",
                 score: str = "score_ban", max_surface: float = 2000.0,
                 as_of: str | None = None) -> list[Check]:
    """The reference's audit checks, as named predicates.

    Fixed values (check names as the reference logs them): null_numero_dpe,
    invalid_etiquette_dpe, invalid_etiquette_ges, date_fin_avant_etablissement,
    surface_<=0, surface_>2000, conso_ep_negative, score_ban_hors_range; the
    duplicate-key check is dup_numero_dpe (see :func:`qc_report`).
    """
    checks = [Check(f"null_{key}", F.col(key).isNull())]
    checks += [Check(f"invalid_{c}", domain_violation(F.col(c), VALID_LABELS)) for c in label_cols]
    checks += [
        Check("date_fin_avant_etablissement", ends_before_start(F.col(end), F.col(start))),
        Check("surface_<=0", F.col(surface) <= 0),
        Check(f"surface_>{int(max_surface)}", F.col(surface) > max_surface),
        Check("conso_ep_negative", F.col(consumption) < 0),
        Check("score_ban_hors_range", (F.col(score) < 0) | (F.col(score) > 1)),
        Check("expired", expired(F.col(end), as_of), logged=False),
    ]
    return checks


def check_counts(df: DataFrame, checks: list[Check], dup_key: str | None = None,
                 dup_check_name: str | None = None, include_info: bool = False) -> DataFrame:
    """(check_name, n) for every check, zero counts included, in one scan.

    Without a duplicate-key check, one global aggregation of ``count_if``s.
    With one, the row checks are counted per key in the same grouped
    aggregation that finds keys seen more than once (partial aggregation
    leaves at most one row per key per task, so a hot key is not a hot
    task), and a second, small aggregation sums them."""
    use = [c for c in checks if c.logged or include_info]
    counts = [F.count_if(c.predicate).alias(f"__c{i}") for i, c in enumerate(use)]
    names = [c.name for c in use]
    if dup_key:
        per_key = df.groupBy(dup_key).agg(F.count(F.lit(1)).alias("__n"), *counts)
        one = per_key.agg(*[F.coalesce(F.sum(f"__c{i}"), F.lit(0)).alias(f"__c{i}") for i in range(len(use))],
                          F.count_if(F.col(dup_key).isNotNull() & (F.col("__n") > 1)).alias(f"__c{len(use)}"))
        names = names + [dup_check_name or f"dup_{dup_key}"]
    else:
        one = df.agg(*counts)
    pairs = ", ".join(f"'{n}', `__c{i}`" for i, n in enumerate(names))
    long = one.selectExpr(f"stack({len(names)}, {pairs}) AS (check_name, n)")
    return long.select("check_name", F.col("n").cast("long").alias("n"))


def qc_report(df: DataFrame, checks: list[Check], dup_key: str | None = None,
              dup_check_name: str | None = None) -> DataFrame:
    """Logged checks with a non-zero count, largest first  (C9, O2)."""
    return (check_counts(df, checks, dup_key, dup_check_name)
            .where(F.col("n") > 0).orderBy(F.desc("n"), F.asc("check_name")))


def qc_totals(report: DataFrame) -> DataFrame:
    """One row: total anomalies and number of failing categories  (A9)."""
    return report.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_anomalies"),
                      F.count(F.lit(1)).alias("n_categories"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) for non-null keys seen more than once  (A4, HAVING)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("n_dup_keys"))


def label_distribution(df: DataFrame, col: str, alias: str = "label") -> DataFrame:
    """UPPER(TRIM(label)) -> count, non-null only, ordered by label  (A3, O1)."""
    return (df.where(F.col(col).isNotNull()).groupBy(upper_trim(F.col(col)).alias(alias))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last(alias)))


def parse_failures(raw: DataFrame, number_cols: list[str] = (), int_cols: list[str] = (),
                   french: bool = True) -> DataFrame:
    """(check_name, n): per text column, non-blank values the tolerant cast
    turns into NULL — the values the clean-up then replaces by a median or a
    default without trace (SURVEY Q13, Q17).  One aggregation."""
    from valora.functions import is_non_blank, parse_fr_number, try_double, try_int_rounded
    parse = parse_fr_number if french else try_double
    checks = [Check(f"unparsable_{c}", is_non_blank(F.col(f"`{c}`")) & parse(F.col(f"`{c}`")).isNull())
              for c in number_cols if c in raw.columns]
    checks += [Check(f"unparsable_{c}", is_non_blank(F.col(f"`{c}`")) & try_int_rounded(F.col(f"`{c}`")).isNull())
               for c in int_cols if c in raw.columns]
    if not checks:
        return raw.sparkSession.createDataFrame([], "check_name string, n bigint")
    return check_counts(raw, checks)
