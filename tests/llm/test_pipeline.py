"""The pipeline stage by stage against brute force, on a driver table."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]

    good = stages["quality_rules"](spark, docs, SF)
    assert good.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    kept = {r.doc_id for r in good.collect()}
    failed = {r.doc_id for r in docs.collect() if brute.quality(r.text)[-1]}
    assert not kept & failed
    clean = [x.doc_id for x in labels if x.quality == 1 and x.doc_id not in failed]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)

    rows = [(r.doc_id, r.text) for r in good.collect()]
    single = stages["near_duplicates"](spark, good, SF)
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, c in brute.classes(rows).values()})

    free = stages["decontamination"](spark, single, SF)
    tests = [s for s in (brute.shingles(x.text, whole=False) for x in items) if s]
    expected = {r.doc_id for r in single.collect()
                if not any(100 * len(s & brute.shingles(r.text, whole=False)) >= 80 * len(s) for s in tests)}
    assert {r.doc_id for r in free.collect()} == expected and free.columns == docs.columns

    mixed = stages["mixing"](spark, free, SF)
    assert mixed.columns == docs.columns
    chosen = [r.doc_id for r in mixed.collect()]
    assert len(chosen) == len(set(chosen)) and set(chosen) <= expected

    placed = stages["sharding"](spark, mixed, SF)
    assert sorted(r.doc_id for r in placed.collect()) == sorted(chosen)
    assert placed.agg(F.min("shard"), F.max("shard")).first()[1] <= 23


def test_run(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).count() > 50
