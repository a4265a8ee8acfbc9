"""Market analytics promised by the reference's documentation
(D3 audit join, D4 geocode fill, D5 in dedup.py, D6 outliers, D7 price
statistics, D8 fair-price verdict).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valora.operators.dedup import latest_per_key
from valora.operators.ranking import (
    exact_quantiles, percent_rank, quantiles_from_ranks, rank_table,
)
from valora.operators.sizing import attach_one_row
from valora.operators.skew import skew_join


def latest_audit_join(sales: DataFrame, audits: DataFrame, sale_keys: list[Column],
                      audit_keys: list[str], audit_order: list, audit_cols: list[str]) -> DataFrame:
    """Each sale with the latest audit of its address (left join; sales
    without an audit keep NULLs)  (D3).  Audits are reduced to one row per
    key first so the join cannot multiply sales.  Sales with a NULL key, or with
    one that very many share, are spread (see ``skew_join``)."""
    names = [f"__ak{i}" for i in range(len(audit_keys))]
    latest = latest_per_key(audits, audit_keys, audit_order).select(
        *[F.col(k).alias(n) for k, n in zip(audit_keys, names)], *audit_cols)
    left = sales.select("*", *[k.alias(n) for k, n in zip(sale_keys, names)])
    return skew_join(left, latest, names, "left").drop(*names)


def geocode_fill(sales: DataFrame, reference: DataFrame, sale_keys: list[Column], ref_keys: list[Column],
                 targets: dict[str, str], ref_order: list, source_alias: str = "coord_source") -> DataFrame:
    """Fill missing sale values (coordinates) from a reference table joined on
    a normalised key, only where the sale lacks them  (D4).

    ``targets`` maps sale column -> reference column.  The reference table is
    reduced to one row per key (``ref_order`` decides which) before the left
    join.  The targets are one point: a sale that lacks any of them takes all of
    them from a reference row that has all, and otherwise stays as it is.
    ``source_alias`` says where each row's values came from: 'own', 'reference'
    or NULL (still incomplete).  Sales with a NULL key, or with one that very many
    share, are spread (see ``skew_join``)."""
    names = [f"__rk{i}" for i in range(len(ref_keys))]
    ref = reference.select(*[k.alias(n) for k, n in zip(ref_keys, names)],
                           *[F.col(v).alias(f"__ref_{s}") for s, v in targets.items()],
                           *[c for c in reference.columns if c not in targets.values()])
    one = latest_per_key(ref, names, ref_order).select(*names, *[f"__ref_{s}" for s in targets])
    left = sales.select("*", *[k.alias(n) for k, n in zip(sale_keys, names)])
    j = skew_join(left, one, names, "left")
    own, got = F.lit(True), F.lit(True)
    for s in targets:
        own, got = own & F.col(s).isNotNull(), got & F.col(f"__ref_{s}").isNotNull()
    use = ~own & got
    # all at once: a target filled first must not count as the sale's own
    j = j.withColumns({source_alias: F.when(own, F.lit("own")).when(got, F.lit("reference")),
                       **{s: F.when(use, F.col(f"__ref_{s}")).otherwise(F.col(s)) for s in targets}})
    return j.drop(*names, *[f"__ref_{s}" for s in targets])


def outlier_fences(df: DataFrame, group_cols: list[str], value_col: str, k: float = 1.5) -> DataFrame:
    """Per group: exact Q1, Q3 (continuous) and the Tukey fences
    Q1 - k*IQR, Q3 + k*IQR  (D6)."""
    q = exact_quantiles(df, group_cols, [value_col], {"q1": 0.25, "q3": 0.75}, name_fmt="{q}")
    iqr = F.col("q3") - F.col("q1")
    return q.select(*group_cols, "q1", "q3", (F.col("q1") - k * iqr).alias("lower_fence"),
                    (F.col("q3") + k * iqr).alias("upper_fence"))


def outlier_filter(df: DataFrame, group_cols: list[str], value_col: str, k: float = 1.5,
                   lower: float | None = None, upper: float | None = None) -> DataFrame:
    """Keep rows inside their group's fences, and inside optional fixed bounds
    (e.g. surface in (0, 2000])  (D6).  Rows with a NULL value are dropped.
    The fence table has one row per group; rows of a group that holds very many
    are spread (see ``skew_join``)."""
    out = df.where(F.col(value_col).isNotNull())
    if lower is not None:
        out = out.where(F.col(value_col) > lower)
    if upper is not None:
        out = out.where(F.col(value_col) <= upper)
    fences = outlier_fences(out, group_cols, value_col, k).select(*group_cols, "lower_fence", "upper_fence")
    j = skew_join(out, fences, group_cols, null_safe=True) if group_cols else attach_one_row(out, fences)
    return (j.where(F.col(value_col).between(F.col("lower_fence"), F.col("upper_fence")))
            .drop("lower_fence", "upper_fence"))


def price_statistics(df: DataFrame, group_cols: list[str], value_col: str, rollup: bool = True,
                     median_alias: str = "median_price", count_alias: str = "n_sales",
                     level_alias: str = "grouping_level", where: Column | None = None) -> DataFrame:
    """Exact median and count of ``value_col`` per group, with ROLLUP
    subtotals when ``rollup``  (D7).

    Rollup levels are produced by one ``explode`` of the level number (one
    scan, like Spark's own Expand): level L keeps the first ``len(g) - L``
    group columns and NULLs the rest; ``grouping_level`` tells a subtotal
    NULL from a data NULL.  ``where`` restricts the rows first, e.g. to one
    kind of transaction (the reference prices all kinds alike, SURVEY Q19)."""
    g = list(group_cols)
    if where is not None:
        df = df.where(where)
    levels = list(range(len(g) + 1)) if rollup else [0]
    x = df.select(*g, F.col(value_col).cast("double").alias("__v"),
                  F.explode(F.array(*[F.lit(lv) for lv in levels])).alias(level_alias))
    x = x.select(*[F.when(F.col(level_alias) <= len(g) - 1 - i, F.col(c)).alias(c) for i, c in enumerate(g)],
                 level_alias, "__v")
    med = exact_quantiles(x, [level_alias, *g], ["__v"], {"median": 0.5}, name_fmt=median_alias,
                          count_alias=count_alias)
    return med.select(*g, level_alias, median_alias, count_alias)


def deal_verdict(df: DataFrame, group_cols: list[str], value_col: str, low: float = 0.9,
                 high: float = 1.1, ratio_alias: str = "ratio_to_median",
                 rank_alias: str = "price_percent_rank", label_alias: str = "verdict",
                 median_alias: str = "local_median") -> DataFrame:
    """Each row's value against its group: ratio to the exact group median,
    exact percent rank inside the group, and a label 'below' (< low),
    'above' (> high) or 'fair'  (D8).  Neither the median nor the rank uses a
    per-group window, so a group holding a third of all rows is not one
    task."""
    g = list(group_cols)
    # one rank table serves both the group median and every row's rank
    rt = rank_table(df.select(*g, F.col(value_col).cast("double").alias(value_col)), g, value_col)
    med = quantiles_from_ranks(rt, g, value_col, {"median": 0.5}, name_fmt=median_alias)
    ranked = percent_rank(df, g, value_col, rank_alias, ranks=rt)
    j = skew_join(ranked, med, g, null_safe=True) if g else attach_one_row(ranked, med)
    ratio = F.when(F.col(median_alias) != 0, F.col(value_col) / F.col(median_alias))
    return (j.withColumn(ratio_alias, ratio)
            .withColumn(label_alias, F.when(F.col(ratio_alias) < low, F.lit("below"))
                        .when(F.col(ratio_alias) > high, F.lit("above"))
                        .when(F.col(ratio_alias).isNotNull(), F.lit("fair"))))
