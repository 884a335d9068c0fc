"""Inline base64 payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.names import suffix

MAX_SUFFIX_CHARS = 16


def is_strict_base64(c: Column) -> Column:
    """No blanks, no missing padding: Spark's own decoder accepts both."""
    return (F.length(c) % 4 == 0) & c.rlike(r"\A[A-Za-z0-9+/]*+={0,2}\z")


def decode_inline(c: Column) -> Column:
    """Payload bytes, or null when the text is not strict base64."""
    return F.when(is_strict_base64(c), F.try_to_binary(c, F.lit("base64")))


def inline_size(c: Column) -> Column:
    """Decoded size from the length of the text alone, before decoding it."""
    pads = F.when(F.endswith(c, F.lit("==")), 2).when(F.endswith(c, F.lit("=")), 1).otherwise(0)
    return F.when(is_strict_base64(c), (F.length(c) / 4).cast("bigint") * 3 - pads)


def inline_suffix(filename: Column) -> Column:
    """The only part of a caller's file name that is kept."""
    given = F.when(F.length(filename) > 0, filename).otherwise(F.lit("document.pdf"))
    kept = F.left(suffix(F.translate(given, "\\", "/")), F.lit(MAX_SUFFIX_CHARS))
    return F.when(kept == "", F.lit(".pdf")).otherwise(kept)
