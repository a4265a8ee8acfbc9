"""Latest version per key, dedup accounting, transaction grouping
(W1, C7, F13, K6, A10, D5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.operators.sizing import attach_one_row


def _sort_exprs(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_per_key(df: DataFrame, key_cols: list[str], order: list, drop_null_keys: bool = True,
                   rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per key under ``order`` (e.g.
    ``[F.desc_nulls_last('modified'), F.desc('id')]``), drop the helper rank.

    ``row_number() ... = 1`` is planned as a partial ``WindowGroupLimit``
    before the shuffle and a final one after, so at most one row per key per
    map task crosses the network even for a key holding a third of the data.
    Rows with a NULL key are dropped first (the reference filters
    ``key IS NOT NULL``).  Add tie-break columns to ``order`` for a
    repeatable result."""
    base = df
    if drop_null_keys:
        for k in key_cols:
            base = base.where(F.col(k).isNotNull())
    w = Window.partitionBy(*key_cols).orderBy(*_sort_exprs(order))
    return base.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def dedup_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, rows after, rows removed  (A10).  Note that
    rows removed include NULL-key rows the dedup filters out."""
    b = before.agg(F.count(F.lit(1)).alias("n_before"))
    a = after.agg(F.count(F.lit(1)).alias("n_after"))
    return attach_one_row(b, a).withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def group_transactions(df: DataFrame, key_cols: list[str], aggs: list[Column] | None = None,
                       count_alias: str = "n_parcels") -> DataFrame:
    """One row per transaction key with the number of rows (parcels) folded
    into it  (D5).  A sale spanning several parcels is listed on several
    rows with the same date, price and address; grouping keeps one."""
    extra = list(aggs or [])
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias(count_alias), *extra)
