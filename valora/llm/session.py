"""What the operators need of a session."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from valora.session import checkpoint_dir

BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2400
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let the session's Python workers import this package from where the
    driver has it; where they have it already (``--py-files``, an image) this
    changes nothing.  Whole texts are large rows: unless the session says
    otherwise, an Arrow batch has ``BATCH_ROWS`` of them, not 10,000."""
    if spark.conf.get(BATCH_CONF, "10000") == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read
    again: cuts the lineage, survives lost executors, and costs compressed
    columns where ``checkpoint()`` writes whole rows.  Shuffle files of the
    write are removed when it ends, not whenever the driver next collects
    garbage: what follows reads the table."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
