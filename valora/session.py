"""Session construction and cluster-shared settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: AQE for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast conversion) and a fixed UTC
# session zone so dates derived from timestamps do not move between hosts.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A pruned CSV scan only validates the columns a query reads, so the
    # same file would yield different good/reject splits per query; parse
    # whole rows so bad-row handling does not depend on the projection.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # checkpoint files are deleted once their RDD is no longer referenced,
    # so the shared checkpoint folder does not grow run after run
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_driver_memory(fraction: float = 0.5, cap_gb: int = 16) -> str:
    """Driver heap for a local-mode session: a share of this machine's
    memory, capped (local mode runs every task inside the driver JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(1, min(cap_gb, int(total * fraction / 2 ** 30)))
    except (ValueError, OSError, AttributeError):
        gb = 4
    return f"{gb}g"


def get_session(master: str | None = None, app_name: str = "valora",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster ``master`` is left to ``spark-submit``; tests and the bench
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("VALORA_DRIVER_MEMORY") or local_driver_memory())
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there and it is used
    as is.  Only a local-mode session without that setting (tests, bench)
    gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        configured = tempfile.mkdtemp(prefix="valora-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
