"""The exploration notebook as Spark jobs: raw-sales profile and clean-up,
audit profile, imputation check, QC report and dedup accounting.

Profiles run on the raw text (so missing measures are visible) and QC on
the imputed table as the reference does; both are one aggregation each
(SURVEY Q17).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valora import schemas
from valora.operators.clean import AuditSpec, clean_audits, drop_null, fill_numeric, fill_text
from valora.operators.dedup import dedup_counts
from valora.operators.profile import missing_profile, residual_nulls
from valora.operators.quality import audit_checks, label_distribution, parse_failures, qc_report, qc_totals
from valora.plans.build import dedup_audits
from valora.sources.delimited import read_delimited
from valora.sources.reconcile import reconcile


def explore_raw_sales(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Pipe-delimited raw sales: keep-list, NULL profile, price not null,
    0 / 'NR' fills, residual NULL check, preview."""
    raw = read_delimited(spark, path, sep="|", schema=None, all_text=True)
    kept, missing = reconcile(raw, schemas.SALES_RAW_PIPE_COLUMNS, fill_missing=False)
    profile = missing_profile(kept, blank_counts=False)
    clean = drop_null(kept, ["Valeur fonciere"])
    # The exploration's 0-filled and 'NR'-filled raw columns.
    clean = fill_numeric(clean, ["Surface reelle bati", "Nombre pieces principales", "Code postal"], "0")
    clean = fill_text(clean, ["Type local", "Code voie", "Voie"])
    return {"profile": profile, "clean": clean, "residual": residual_nulls(clean),
            "preview": clean.limit(20), "missing_columns": spark.createDataFrame(
                [(c,) for c in missing], "column_name string")}


def explore_audits(raw: DataFrame, as_of: str | None = None, spec: AuditSpec | None = None) -> dict[str, DataFrame]:
    spec = spec or AuditSpec()
    kept, _missing = reconcile(raw, schemas.AUDIT_COLUMNS, fill_missing=False)
    imputed = clean_audits(kept, spec)
    final = dedup_audits(imputed, spec)
    report = qc_report(imputed, audit_checks(as_of=as_of), dup_key=spec.key)
    return {
        "profile": missing_profile(kept),
        "lost_values": parse_failures(kept, spec.measures, [c for c, _ in spec.int_default]),
        "imputed": imputed,
        "residual": residual_nulls(imputed),
        "qc_report": report,
        "qc_totals": qc_totals(report),
        "labels": label_distribution(imputed, "etiquette_dpe"),
        "expired": imputed.agg(F.count_if(
            F.col(spec.dates[1]) < (F.current_date() if as_of is None else F.lit(as_of).cast("date"))
        ).alias("n_expired")),
        "final": final,
        "dedup": dedup_counts(imputed, final),
    }
