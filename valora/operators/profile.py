"""Missing-value profile and residual-null check.

One aggregation computes every column's count in a single scan (the
reference runs one query per column); ``stack`` then turns the one-row
result into a long (column, n, pct, flag) frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valora.functions import is_missing, pct, threshold_label


def _long_counts(df: DataFrame, cols: list[str], predicate) -> DataFrame:
    return _long_counts_by(df, cols, lambda name: predicate(F.col(f"`{name}`")))


def _long_counts_by(df: DataFrame, cols: list[str], predicate_of_name) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.count_if(predicate_of_name(c)).alias(f"__n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', `__n{i}`" for i, c in enumerate(cols))
    return one.selectExpr("__total", f"stack({len(cols)}, {pairs}) AS (column_name, n)")


def missing_profile(df: DataFrame, cols: list[str] | None = None, blank_counts: bool = True,
                    high: float = 20.0, low: float = 5.0) -> DataFrame:
    """(column_name, n, pct, flag): rows missing per column, percent of all rows
    rounded to 2, and a two-level flag (> ``high`` -> 'high', > ``low`` ->
    'medium').  ``blank_counts`` counts blank text as missing (F5); else only
    NULL (F6).  A zero-row input gives NULL pct."""
    cols = cols or df.columns
    dtypes = dict(df.dtypes)

    def missing(col_name):
        c = F.col(f"`{col_name}`")
        return is_missing(c) if (blank_counts and dtypes.get(col_name) == "string") else c.isNull()

    long = _long_counts_by(df, cols, missing)
    p = pct(F.col("n"), F.col("__total"))
    return long.select("column_name", F.col("n").cast("long").alias("n"), p.alias("pct"),
                       threshold_label(p, high, low).alias("flag"))


def residual_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, n) for columns that still hold NULLs; empty when clean  (A7)."""
    cols = cols or df.columns
    long = _long_counts(df, cols, lambda c: c.isNull())
    return long.where(F.col("n") > 0).select("column_name", F.col("n").cast("long").alias("n"))
