"""Distributed order statistics: exact quantiles, percent rank, dense ids.

The reference computes medians with one ``MEDIAN`` query per column, and
surrogate keys with ``ROW_NUMBER() OVER ()``.  In Spark the direct forms do
not scale: a global ``percentile`` merges every distinct value of a group
into one aggregation buffer, and a window without ``PARTITION BY`` (or with a
hot key) sorts everything in one task.

Everything here is built on one primitive, :func:`rank_table`:

1. pre-aggregate ``(group, value) -> count`` (map-side partial aggregation
   collapses repeated values, so a value held by a third of all rows is one
   row from here on);
2. range-partition the distinct pairs on ``(group, value)``: a hot group is
   split over many partitions, each a contiguous slice of its sorted values;
3. running count inside each ``(partition, group)`` slice (bounded by the
   partition size), plus a tiny table of per-slice totals whose running sum
   over partitions gives each slice's offset.

``before`` (rows of the group with a smaller value) = slice offset + running
count; from it quantiles, ranks and ids follow with plain aggregates/joins.
All steps are JVM-side DataFrame operators; nothing is collected.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valora.functions.numeric import fused_multiply_add
from valora.operators.sizing import attach_one_row, default_parallelism
from valora.operators.skew import skew_join
from valora.session import checkpoint_dir


def stable(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    again: every later consumer sees the same rows, an executor loss does not
    recompute them differently, and the lineage ends.  ``checkpoint()`` would
    compute ``df`` twice, once to count and once to write.  Folders are named by application, so what
    one leaves can be removed when it has ended; zstd, as what is written here is read only a few times."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (rollup levels carry NULL
    group keys)."""
    if not keys:
        return attach_one_row(left, right)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def rank_table(df: DataFrame, group_cols: list[str], value_col: str,
               num_partitions: int | None = None) -> DataFrame:
    """One row per distinct ``(group..., value)`` (NULL values included, with
    weight 0) with columns ``_cnt`` (rows holding the value), ``_before``
    (non-null rows of the group with a strictly smaller value), ``_n``
    (non-null rows of the group), ``_rows`` (all rows holding the value,
    NULL included, so ``sum(_rows)`` per group is COUNT(*)) and ``_nulls``
    (NULL rows of the group).

    A slice is a range of the distinct (group, value) pairs by sampled
    splitters, so neither a hot group nor values that lie close together are one task."""
    g = list(group_cols)
    v = value_col
    weight = F.when(F.col(v).isNull(), F.lit(0)).otherwise(F.lit(1))
    agg = df.groupBy(*g, v).agg(F.sum(weight).cast("long").alias("_cnt"),
                                F.count(F.lit(1)).alias("_rows"))
    return _range_ranks(agg, g, v, num_partitions or default_parallelism(df))


def _range_ranks(agg: DataFrame, g: list[str], v: str, parts: int) -> DataFrame:
    """``rank_table`` of distinct ``(group..., value)`` with ``_cnt`` and ``_rows``."""
    # The range boundaries come from a sample, and a recomputed sample may
    # differ; the tagged slices are therefore written once (reliable
    # checkpoint in the cluster's checkpoint folder) and both consumers below
    # read the same partition ids.  This also cuts the lineage.
    srt = stable(agg.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in g + [v]])
                 .withColumn("_pid", F.spark_partition_id()))

    # running count inside each (partition, group) slice
    w_local = (Window.partitionBy("_pid", *g).orderBy(F.col(v).asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    local = srt.withColumn("_local", F.coalesce(F.sum("_cnt").over(w_local), F.lit(0)).cast("long"))

    # slice offsets: a table of (partition, group) totals, at most
    # partitions + groups rows
    slices = srt.groupBy("_pid", *g).agg(F.sum("_cnt").alias("_ptotal"),
                                         F.sum(F.col("_rows") - F.col("_cnt")).alias("_pnulls"))
    gkey = [F.col(c) for c in g] if g else [F.lit(0)]
    w_off = Window.partitionBy(*gkey).orderBy("_pid")
    slices = (slices
              .withColumn("_offset", F.coalesce(
                  F.sum("_ptotal").over(w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_n", F.sum("_ptotal").over(Window.partitionBy(*gkey)))
              .withColumn("_nulls", F.sum("_pnulls").over(Window.partitionBy(*gkey)).cast("long"))
              .drop("_ptotal", "_pnulls"))
    out = _null_safe_join(local, slices, ["_pid", *g])
    return (out.withColumn("_before", (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_offset", "_local", "_pid"))


_BIG = 1 << 62


def value_bucket(v: Column, scale: float = 64.0) -> Column:
    """An order-preserving bucket of a number: ``v1 < v2`` implies
    ``bucket(v1) <= bucket(v2)`` (log1p is semi-monotonic, scaling by a
    positive constant and floor are monotonic; negatives mirror positives).
    Buckets are log-spaced, so skewed value ranges still spread; NULL, -inf,
    +inf and NaN get the outermost buckets in Spark's sort order."""
    v = v.cast("double")
    mag = F.floor(F.log1p(F.abs(v)) * F.lit(float(scale)))
    return (F.when(v.isNull(), F.lit(-_BIG))
            .when(F.isnan(v), F.lit(_BIG))
            .when(v == float("inf"), F.lit(_BIG - 1))
            .when(v == float("-inf"), F.lit(-_BIG + 1))
            .when(v >= 0, mag)
            .otherwise(-mag - 1)).cast("long")


def _interpolate(lo: Column, hi: Column, frac: Column) -> Column:
    # (1 - f) * lo + f * hi with the multiply-add fused, which is how the
    # reference engine's compiled continuous quantile rounds; results agree
    # to the last bit.
    return F.when(frac == 0, lo).otherwise(fused_multiply_add(F.lit(1.0) - frac, lo, frac * hi))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_cols: list[str],
                    quantiles: dict[str, float] | None = None,
                    name_fmt: str = "{q}_{col}",
                    count_alias: str | None = None) -> DataFrame:
    """Exact continuous quantiles (``quantile_cont`` / ``MEDIAN``) of several
    columns per group, NULLs ignored, in two passes.

    Pass 1 counts rows per (group, measure, value bucket), a small table after
    partial aggregation, whose running sums tell the buckets that hold a wanted
    rank.  Pass 2 keeps only the rows in those buckets and ranks their distinct
    values over range partitions by sampled splitters; nothing else is shuffled.

    Returns one row per group with a column ``name_fmt.format(q=name, col=c)``
    per (quantile, value column); a group whose values are all NULL yields
    NULL.  ``count_alias`` adds the group's COUNT(*) (from pass 1).
    """
    quantiles = quantiles or {"median": 0.5}
    g = list(group_cols)
    key = [*g, "_measure"]
    longf = df.select(*g, *[F.col(c).cast("double").alias(c) for c in value_cols]).unpivot(
        g, value_cols, "_measure", "_value").withColumn("_b", value_bucket(F.col("_value")))
    family = Window.partitionBy(*key)
    totals = (longf.groupBy(*key, "_b").agg(F.count("_value").alias("_cnt"), F.count(F.lit(1)).alias("_rows"))
              .withColumn("_n", F.sum("_cnt").over(family))
              .withColumn("_start", F.coalesce(F.sum("_cnt").over(
                  family.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    wanted = F.lit(False)
    for q in quantiles.values():
        pos = (F.col("_n") - 1) * F.lit(float(q))
        for rank in (F.floor(pos), F.ceil(pos)):
            wanted = wanted | ((F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_cnt")))
    held = totals.filter(wanted).select(*key, "_b", "_n", "_start")
    inner = (_null_safe_join(longf.filter(F.col("_value").isNotNull()), held.select(*key, "_b"), [*key, "_b"])
             .groupBy(*key, "_b", "_value").agg(F.count(F.lit(1)).alias("_cnt"), F.count(F.lit(1)).alias("_rows")))
    # a bucket may hold nearly all rows, where values lie close together: its
    # distinct values are ranked over range partitions, not in one task
    within = _range_ranks(inner, [*key, "_b"], "_value", default_parallelism(df)).drop("_n", "_nulls", "_rows")
    ranks = _null_safe_join(within, held, [*key, "_b"]).withColumn("_before", F.col("_start") + F.col("_before"))
    per = quantiles_from_ranks(ranks, key, "_value", quantiles, name_fmt="__q_{q}")
    # every group and measure, also those without a value
    every = totals.groupBy(*key).agg(F.sum("_rows").alias("__rows"))
    per = _null_safe_join(every, per, key, "left")
    # back to wide: one column per (quantile, measure); tiny input
    wide = []
    for qname in quantiles:
        for c in value_cols:
            wide.append(F.max(F.when(F.col("_measure") == c, F.col(f"__q_{qname}")))
                        .alias(name_fmt.format(q=qname, col=c)))
    if count_alias:
        wide.append(F.max("__rows").cast("long").alias(count_alias))
    return per.groupBy(*g).agg(*wide) if g else per.agg(*wide)


def quantiles_from_ranks(rt: DataFrame, group_cols: list[str], value_col: str, quantiles: dict[str, float],
                         name_fmt: str = "{q}", rows_alias: str | None = None) -> DataFrame:
    """Exact continuous quantiles per group read off a :func:`rank_table`:
    the values at ranks floor/ceil of (n - 1) * q, interpolated.  One
    aggregation over the (distinct-value) rank table."""
    n1 = F.col("_n") - 1
    aggs, finals = [], []
    for qname, q in quantiles.items():
        pos = n1 * F.lit(float(q))
        k_lo, k_hi = F.floor(pos), F.ceil(pos)
        live = F.col("_cnt") > 0
        hit_lo = (F.col("_before") <= k_lo) & (k_lo < F.col("_before") + F.col("_cnt")) & live
        hit_hi = (F.col("_before") <= k_hi) & (k_hi < F.col("_before") + F.col("_cnt")) & live
        aggs += [F.max(F.when(hit_lo, F.col(value_col))).alias(f"__lo_{qname}"),
                 F.max(F.when(hit_hi, F.col(value_col))).alias(f"__hi_{qname}"),
                 F.max(F.when(live, pos - k_lo)).alias(f"__f_{qname}")]
        finals.append(_interpolate(F.col(f"__lo_{qname}"), F.col(f"__hi_{qname}"), F.col(f"__f_{qname}"))
                      .alias(name_fmt.format(q=qname)))
    if rows_alias:
        aggs.append(F.sum("_rows").alias(rows_alias))
    per = rt.groupBy(*group_cols).agg(*aggs)
    return per.select(*group_cols, *finals, *([rows_alias] if rows_alias else []))


def exact_median(df: DataFrame, group_cols: list[str], value_col: str, alias: str) -> DataFrame:
    return exact_quantiles(df, group_cols, [value_col], {"median": 0.5}, name_fmt=alias)


def percent_rank(df: DataFrame, group_cols: list[str], value_col: str, alias: str,
                 num_partitions: int | None = None, ranks: DataFrame | None = None) -> DataFrame:
    """Add ``alias`` = PERCENT_RANK() OVER (PARTITION BY group ORDER BY value)
    without a window per group: (rows of the group below the value) / (n-1).
    NULL values rank first, as in an ascending Spark/DuckDB window.  Pass
    ``ranks`` to reuse a :func:`rank_table` already built for the frame."""
    g = list(group_cols)
    rt = ranks if ranks is not None else rank_table(df.select(*g, value_col), g, value_col, num_partitions)
    nn = F.col("_nulls")
    total = F.col("_n") + nn
    before = F.when(F.col(value_col).isNull(), F.lit(0)).otherwise(F.col("_before") + nn)
    rt = rt.select(*g, value_col,
                   F.when(total <= 1, F.lit(0.0)).otherwise(before / (total - 1)).alias(alias))
    return skew_join(df, rt, g + [value_col], null_safe=True)


def dense_id(df: DataFrame, order_cols: list, alias: str, num_partitions: int | None = None,
             keep: list[str] | None = None) -> DataFrame:
    """Add ``alias`` = ROW_NUMBER() OVER (ORDER BY order_cols), 1-based.

    The input is range-partitioned, sorted on ``order_cols`` (which must be a
    unique key for a repeatable numbering) and written once (reliable
    checkpoint); each row's index inside its partition comes from
    ``monotonically_increasing_id`` (partition id in the upper 31 bits, row
    number within the partition in the lower 33), and the partition's start
    offset from a table of per-partition counts: one row per partition, so
    broadcasting it is bounded by the partition count.  ``keep`` names the
    columns that stay, so that those of the order alone are not written.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    parts = num_partitions or default_parallelism(df)
    tagged = stable(df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
                    .select(*[F.col(f"`{c}`") for c in keep or df.columns], F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mono")))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"))
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_pc").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return out.withColumn(alias, (F.col("_off") + local + 1).cast("long")).drop("_pid", "_mono", "_off")


def hash_id(*cols) -> Column:
    """64-bit hash surrogate key of a natural key (stable across runs and
    partitionings; collisions become likely only past ~10^8 distinct keys)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def wide_hash_id(*cols) -> Column:
    """128-bit hash surrogate key (hexadecimal) of a natural key, for tables
    past the reach of 64 bits; NULL differs from every text."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\x1f-")) for c in cols]
    return F.md5(F.concat(*[x for p in parts for x in (p, F.lit("\x1e"))]))
