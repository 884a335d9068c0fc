"""Held-out accuracy of the classifiers, and the whole pipeline, on the given small tables."""

from __future__ import annotations

import pytest

SOME = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, column, least", [("op9_quality_classifier", "quality", 0.95), ("op10_toxicity", "toxic", 0.88)])
def test_held_out_accuracy(spark, name, column, least):
    from docloom.llm import queries

    labels = spark.read.parquet(f"{SOME}/labels.parquet")
    rows = queries.all_queries()[name](spark, SOME).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 100
    assert sum(r.predicted == r[column] for r in rows) / len(rows) >= least


def test_scores_do_not_see_held_out_labels(spark):
    from pyspark.sql import functions as F

    from docloom.llm.common import held_out
    from docloom.llm.quality import score_quality

    docs = spark.read.parquet(f"{SOME}/documents.parquet").limit(200)
    labels = spark.read.parquet(f"{SOME}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (dict(score_quality(docs, t).select("doc_id", "score").collect()) for t in (labels, turned))
    assert one == two


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SOME}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, docs, SOME), "test-stage")
        assert after.columns == docs.columns
        assert 0 < after.count() <= docs.count()
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SOME)
    assert last.count() == docs.count()
