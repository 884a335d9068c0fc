"""From raw markdown to the typed result record under one byte budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import budget as B
from docloom.functions.text import is_blank, with_plain_text
from docloom.limits import MIB
from docloom.operators.outcomes import empty_failure


def mirror_warning(budget: int) -> str:
    size = f"{budget // MIB} MiB" if budget % MIB == 0 else f"{budget} bytes"
    return (
        f"plain text is cut so that the answer stays within {size}; "
        "`markdown` holds everything"
    )


def share_budget(df: DataFrame, budget: int, min_text: int) -> DataFrame:
    """Splits one budget: ``markdown`` first, ``text`` gets what is left.

    Adds ``text``, ``whole_markdown`` and ``whole_text``.  Each stage refers to
    the costly value of the one before by name, so it is computed once.
    """
    left = F.col("_left")
    split = (
        df.withColumn("whole_markdown", B.fits(F.col("markdown"), budget))
        .withColumn("_clipped", B.clip_bytes(F.col("markdown"), budget))
        .withColumn("_left", F.lit(budget) - F.octet_length("_clipped"))
        .withColumn("_source", F.when(left >= min_text, F.col("markdown")))
    )
    return (
        with_plain_text(split, "_source", "_plain")
        .withColumn("whole_text", F.coalesce(F.octet_length("_plain") <= left, F.lit(False)))
        .withColumn("text", F.coalesce(B.clip_bytes(F.col("_plain"), left), F.lit("")))
        .withColumn("markdown", F.col("_clipped"))
        .drop("_clipped", "_left", "_source", "_plain")
    )


def job_warnings(budget: int, *lists: Column) -> Column:
    """Warnings in order, with the mirror warning last when text was clipped."""
    last = F.when(~F.col("whole_text"), F.array(F.lit(mirror_warning(budget))))
    none = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(x, none) for x in lists], F.coalesce(last, none))


def shape_results(
    parsed: DataFrame,
    budget: int,
    min_text: int,
    backend: str = "docloom",
    backend_version: str | None = None,
    host_warnings: list[str] | None = None,
) -> DataFrame:
    """Adds the outcome and the nested ``result`` to parsed documents.

    Needs ``filename, markdown, warnings, sources, page_count, over_budget,
    parse_backend, error_code, error, missing_dependencies``.  Blank markdown is
    a failure, and a failed document has no result.
    """
    blank = F.col("error_code").isNull() & (
        F.col("markdown").isNull() | is_blank(F.col("markdown"))
    )
    empty = empty_failure(F.col("filename"))
    typed = (
        parsed.withColumn("_blank", blank)
        .withColumn("error_code", F.when(F.col("_blank"), empty["error_code"]).otherwise(F.col("error_code")))
        .withColumn("error", F.when(F.col("_blank"), empty["error"]).otherwise(F.col("error")))
        .withColumn("markdown", F.when(F.col("error_code").isNull(), F.col("markdown")))
        .drop("_blank")
    )
    shaped = share_budget(typed, budget, min_text)
    host = F.array(*[F.lit(w) for w in host_warnings or []]).cast("array<string>")
    record = F.struct(
        F.lit(backend).alias("backend"),
        F.lit(backend_version).cast("string").alias("backend_version"),
        F.col("markdown"),
        F.col("text"),
        job_warnings(budget, host, F.col("warnings")).alias("warnings"),
        (~F.col("whole_markdown") | F.coalesce("over_budget", F.lit(False))).alias("truncated"),
        F.struct(
            F.col("filename"), F.col("page_count"), F.col("sources"), F.col("parse_backend")
        ).alias("metadata"),
    )
    return shaped.withColumn("result", F.when(F.col("error_code").isNull(), record)).drop(
        "markdown", "text", "warnings", "sources", "page_count", "over_budget",
        "whole_markdown", "whole_text", "parse_backend",
    )
