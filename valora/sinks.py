"""Sinks and table lifecycle.

Tables are Parquet folders (or catalog tables); "create or replace" is an
overwrite, intermediate tables are lazy DataFrames so there is nothing to
drop, and a view is a session temp view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, target: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", fmt: str = "parquet", as_table: bool = False,
                bucket_by: tuple[int, list[str]] | None = None) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT  (K1, K2).

    ``target`` is a folder (default) or a catalog table name with
    ``as_table``; ``bucket_by=(n, cols)`` buckets a catalog table so later
    joins on ``cols`` need no shuffle."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        if bucket_by:
            w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
        w.saveAsTable(target)
    else:
        w.save(target)


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", as_table: bool = False) -> DataFrame:
    return spark.table(target) if as_table else spark.read.format(fmt).load(target)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE VIEW / register a frame as a relation  (K4, S11)."""
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    """DROP VIEW IF EXISTS / unregister  (K5, S11)."""
    return spark.catalog.dropTempView(name)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """ALTER TABLE ... DROP COLUMN  (K6)."""
    return df.drop(*cols)


def describe(df: DataFrame) -> DataFrame:
    """DESCRIBE: (column_name, column_type), from the schema only  (K7)."""
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                 "column_name string, column_type string")


def temp_persist(df: DataFrame) -> DataFrame:
    """A temp table used more than once  (K3): cached in memory, spilling
    to disk; recomputed from lineage if an executor is lost."""
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def row_count(df: DataFrame) -> DataFrame:
    """COUNT(*) as a one-row frame  (A1)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
