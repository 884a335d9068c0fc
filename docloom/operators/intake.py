"""Request and input checks.  All of them are row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import names as N
from docloom.functions import payload as P
from docloom.functions.text import is_blank, py_strip
from docloom.operators.outcomes import message

SHAPE_ERROR = "a request needs either `path` or `content_base64`, and not both"


def request_shape_error(path: Column, content: Column) -> Column:
    """Exactly one of the two must be given; an empty string is not given."""
    has_path = F.coalesce(F.length(path) > 0, F.lit(False))
    has_content = F.coalesce(F.length(content) > 0, F.lit(False))
    return F.when(has_path == has_content, F.lit(SHAPE_ERROR))


def size_error(size: Column, max_bytes: int, what: str = "input") -> Column:
    return F.when(
        size > max_bytes,
        message(f"{what} is ", size.cast("string"), f" bytes, over the {max_bytes}-byte limit"),
    )


def inline_error(content: Column, max_bytes: int) -> Column:
    """Checked from the text's length, so nothing oversized is ever decoded."""
    size = P.inline_size(content)
    return (
        F.when(size.isNull(), F.lit("`content_base64` cannot be decoded"))
        .when(size == 0, F.lit("`content_base64` holds no bytes"))
        .otherwise(size_error(size, max_bytes, "sent content"))
    )


def confinement_error(path: Column, roots: list[str], real_path: Column | None = None) -> Column:
    """An empty list of roots admits nothing.

    With ``real_path`` (``sources.tree.real_paths``) the place that the links on the way lead
    to is what must lie under a root; ``roots`` are to be given resolved then.
    """
    asked = py_strip(path if real_path is None else real_path)
    shown = ", ".join(roots) or "(none)"
    return F.when(is_blank(path), F.lit("missing `path`")).when(
        ~N.within_roots(N.fold_path(asked), roots),
        message("`", asked, f"` is not under any allowed root ({shown})"),
    )


def check_requests(
    requests: DataFrame, roots: list[str], max_input_bytes: int, size: Column | None = None,
    real_path: Column | None = None,
) -> DataFrame:
    """Adds ``accepted``, ``error_code`` and ``error`` to every request.

    ``size`` is the length of the file named by ``path``, where a listing knows
    it.  A badly shaped request has a message and no code.
    """
    path, content = F.col("path"), F.col("content_base64")
    shape = request_shape_error(path, content)
    by_path = confinement_error(path, roots, real_path)
    if size is not None:
        by_path = F.coalesce(by_path, size_error(size, max_input_bytes))
    rejected = F.when(F.length(content) > 0, inline_error(content, max_input_bytes)).otherwise(
        by_path
    )
    return (
        requests.withColumn("_shape", shape)
        .withColumn("_rejected", F.when(F.col("_shape").isNull(), rejected))
        .withColumn("accepted", F.coalesce("_shape", "_rejected").isNull())
        .withColumn("error_code", F.when(F.col("_rejected").isNotNull(), "input_rejected"))
        .withColumn("error", F.coalesce("_shape", "_rejected"))
        .drop("_shape", "_rejected")
    )


def inline_files(requests: DataFrame, max_input_bytes: int) -> DataFrame:
    """Accepted inline requests as files: ``request_id, path, content``.

    Of the caller's file name only the suffix is kept; it decides how the bytes
    are read.
    """
    path, content = F.col("path"), F.col("content_base64")
    passed = request_shape_error(path, content).isNull() & (F.length(content) > 0)
    return requests.where(passed & inline_error(content, max_input_bytes).isNull()).select(
        "request_id",
        F.concat(
            F.lit("inline/"), F.col("request_id").cast("string"), P.inline_suffix(F.col("filename"))
        ).alias("path"),
        P.decode_inline(content).alias("content"),
    )
