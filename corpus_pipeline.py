"""A training corpus from raw documents: STAGES in order, each written before the next reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm.bpe import encode_documents
from docloom.llm.common import staged, table
from docloom.llm.decontaminate import without_contaminated
from docloom.llm.linededup import without_repeated_lines
from docloom.llm.ngramjoin import one_of_each
from docloom.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, lines that repeat across them left in one only."""
    return without_repeated_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return encode_documents(docs, ids=True)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# Classifier, links and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
