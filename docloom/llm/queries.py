"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.ngramjoin import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents")).drop("mark")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.decontaminate import find_contamination

    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return find_contamination(docs, benchmark).drop("mark")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.linededup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.htmltext import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.tokencount import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from docloom.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.vectorcodes import compress

    return compress(table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.idfiles import token_files

    return token_files(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.runs import periodic_runs

    return periodic_runs(table(spark, sf_dir, "documents"), plant=True, outputs=False)


def all_queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2:3].isdigit()}


def all_sql() -> dict[str, str]:
    from docloom.llm import linededup, vectorcodes

    return {"op3_line_dedup": linededup.SQL, "op11_vector_codes": vectorcodes.SQL}
