"""A corpus pipeline over ``documents``: quality rules, near duplicates,
benchmark decontamination, mixing, sharding.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet and reads
again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valora.llm.decontaminate import drop_leaks
from valora.llm.mixing import mix
from valora.llm.ngram_join import keep_one
from valora.llm.quality import keep_quality
from valora.llm.session import ready, stored, table
from valora.llm.sharding import reshard_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ready(spark)
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    ready(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"), short=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents a mixture with equal weights takes, none twice."""
    return mix(docs, share=MIX_SHARE, max_epochs=1, epoch_col=None)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document went: files of shards by source, rewritten as 24
    shards of near-equal bytes."""
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(20))
    placed = reshard_table(docs.select("doc_id", "source", "lang", "text"), old, 24)
    return placed.select("doc_id", "lang", "source", "size", "old_shard", "shard", "slot")


#: Share of the tokens that the mixture takes.
MIX_SHARE = 0.9

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: n-gram joins with connected components and flow solutions are no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
