"""Parallelism and one-row attachments.

Broadcasts are left to Spark, which compares measured bytes with
``spark.sql.autoBroadcastJoinThreshold`` at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def default_parallelism(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame (medians, totals) to every row.

    The one-row frame (a global aggregate, so exactly one row) is packed into
    one struct and used as a scalar subquery: Spark evaluates it once and
    attaches the values to every row without a join."""
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("__one")).scalar()
    out = df.withColumn("__one", packed)
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[F.col("__one").getField(c).alias(c) for c in one_row.columns])
