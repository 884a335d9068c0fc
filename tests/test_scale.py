"""Plans and skew: what must hold however large the tables are."""

import re

import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F

from docloom.operators import archive as A
from docloom.operators import ledger as L

QUERIES = contract.queries()
# These run a stream or write a stage first; what they return is a plain scan.
STAGED = {"doc_stream", "job_stream", "job_stream_timers", "job_stream_retained", "output_scan", "parse_job_archives", "result_sink", "document_scan", "document_stream", "parse_requests"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STAGED))
def test_no_cross_join_and_no_row_udf(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    # A scalar Python function; a table function in Python is a node of its own.
    assert not re.search(r"(Batch|Arrow)EvalPython(?!UDTF)", text)


def test_text_never_leaves_its_stage(spark, small):
    """Deciding what goes into an archive moves sizes and names, not text."""
    from docloom.plans import inputs as inp

    text = plan(A.assembly_plan(inp.parsed_members(spark, small), 60_000, 1000))
    assert text.count("Exchange hashpartitioning") == 1
    beyond = text.split("Exchange hashpartitioning")[0]
    assert "markdown" not in beyond


def test_stored_sizes_spare_the_text(spark, small, tmp_path):
    from docloom.plans import inputs as inp

    stage = str(tmp_path / "parsed")
    A.with_body_bytes(inp.parsed_members(spark, small)).write.parquet(stage)
    members = spark.read.parquet(stage)
    assert "markdown" not in plan(A.assembly_plan(members, 60_000, 1000))
    fresh = A.assemble_archives(inp.parsed_members(spark, small), 20_000, 1000)
    assert sorted(map(str, A.assemble_archives(members, 20_000, 1000).collect())) == sorted(map(str, fresh.collect()))


def test_contents_move_once_and_unsorted(spark):
    rows = spark.range(10).selectExpr("'a' archive", "id ordinal", "'n' name", "cast(cast(id as string) as binary) content")
    text = plan(A.last_copies(rows.select("archive", "ordinal", "name"), rows.select("archive", "ordinal", "content")))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    assert not [line for line in text.split("\n") if "Sort [" in line and "content" in line]


def test_row_local_queries_do_not_shuffle(spark, small):
    from docloom.functions.text import with_plain_text
    from docloom.operators.results import share_budget
    from docloom.plans import inputs as inp

    docs = inp.table(spark, small, "documents").select("doc_id", F.col("text").alias("markdown"))
    for df in (with_plain_text(docs, "markdown", "p"), share_budget(docs, 3000, 500)):
        assert "Exchange" not in plan(df)


def test_folds_combine_before_the_shuffle(spark, small):
    from docloom.plans import inputs as inp

    text = plan(L.job_snapshots(inp.job_events(spark, small)))
    assert "partial_min" in text and text.count("Exchange") == 1 and "SortAggregate" not in text


def test_scans_read_only_their_columns(spark, small):
    text = plan(QUERIES["size_cap"](spark, small))
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


def test_hot_archive_is_bounded_before_the_shuffle(spark):
    """A third of all rows in one archive: past its cap no row is shuffled."""
    rows = spark.range(0, 27_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (F.col("id") / 90).cast("int"))).alias("archive"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3).otherwise(F.col("id") % 90).cast("bigint").alias("ordinal"),
        F.concat(F.col("id").cast("string"), F.lit(".pdf")).alias("name"),
        F.lit("text").alias("markdown"), F.lit(None).cast("bigint").alias("page_count"),
        F.lit(None).cast("string").alias("error_code"), F.lit(None).cast("string").alias("error"),
    )
    got = {r.archive: r for r in A.assemble_archives(rows, 10_000, 512).collect()}
    assert got["hot"].error_code == "input_rejected" and got["hot"].n_members == 513
    assert all(r.error_code is None and r.n_members == 60 for k, r in got.items() if k not in ("hot",))
