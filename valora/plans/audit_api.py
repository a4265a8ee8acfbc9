"""The API audit load (the reference's second entry point), re-aimed at
landed cursor pages under ``region=<r>/year=<y>/`` folders.

pages -> records (all text, missing -> '' as the API loader does, then
blank -> NULL at the source, SURVEY Q11) -> slice completeness -> same
clean-up and latest-version dedup as the file load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valora import schemas
from valora.operators.clean import AuditSpec, clean_audits
from valora.plans.build import dedup_audits
from valora.sources.json_pages import read_cursor_slices, read_slice_pages, slice_completeness
from valora.sources.reconcile import reconcile


def load(spark: SparkSession, path: str, regions=None, years=None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Return ``(audits, completeness, missing_columns)``.  ``regions`` /
    ``years`` prune folders (partition filters), the landed-file form of the
    API's ``_eq`` / ``_gte`` / ``_lte`` slice parameters."""
    wanted = F.lit(True)
    if regions:
        wanted = wanted & F.col("region").isin([str(r) for r in regions])
    if years:
        wanted = wanted & F.col("year").isin([str(y) for y in years])
    recs = read_cursor_slices(spark, path, schemas.AUDIT_API_TEXT).where(wanted)
    completeness = slice_completeness(read_slice_pages(spark, path, schemas.AUDIT_API_TEXT).where(wanted))
    kept, missing = reconcile(recs, schemas.AUDIT_COLUMNS, fill_missing=False)
    kept = kept.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in kept.columns])
    spec = AuditSpec()
    return dedup_audits(clean_audits(kept, spec), spec), completeness, missing
