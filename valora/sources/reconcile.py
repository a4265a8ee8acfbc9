"""Keep-list reconciliation.

kept = wanted ∩ present, in the wanted order; a wanted column the source
lacks becomes a typed NULL column instead of failing the projection later.
Only the schema (driver-side metadata) is read; no data moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(df: DataFrame, wanted: list[str], types: dict[str, str] | None = None,
              fill_missing: bool = True) -> tuple[DataFrame, list[str]]:
    """Return ``(frame, missing)``: the frame projected to ``wanted`` (missing
    columns as NULL of ``types.get(c, 'string')`` when ``fill_missing``, else
    left out) and the list of wanted columns the source did not have."""
    types = types or {}
    present = set(df.columns)
    missing = [c for c in wanted if c not in present]
    cols = []
    for c in wanted:
        if c in present:
            cols.append(F.col(f"`{c}`"))
        elif fill_missing:
            cols.append(F.lit(None).cast(types.get(c, "string")).alias(c))
    return df.select(*cols), missing
