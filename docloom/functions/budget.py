"""Byte budgets over UTF-8 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import py_strip
from docloom.limits import LOG_TAIL_BYTES, LOG_TAIL_CHARS


def _int(n: int | Column) -> Column:
    return n if isinstance(n, Column) else F.lit(n)


def fits(c: Column, budget: int | Column) -> Column:
    return F.octet_length(c) <= _int(budget)


def clip_bytes(c: Column, budget: int | Column) -> Column:
    """Longest prefix of at most ``budget`` bytes that ends between characters.

    A cut is inside a character when the byte after it is a continuation byte
    (0x80-0xBF); at most three steps back reach the boundary.
    """
    n = _int(budget)
    raw = c.cast("binary")

    def inside(at: Column) -> Column:
        following = F.substring(raw, at + 1, F.lit(1))
        return (following >= F.lit(b"\x80")) & (following <= F.lit(b"\xbf"))

    cut = F.when(~inside(n), n).when(~inside(n - 1), n - 1).when(~inside(n - 2), n - 2)
    kept = F.substring(raw, F.lit(1), cut.otherwise(n - 3)).cast("string")
    return F.when(fits(c, n), c).when(n <= 0, F.lit("")).otherwise(kept)


def lossy_text(raw: Column, max_bytes: int) -> Column:
    """First ``max_bytes + 1`` bytes as text, bad sequences replaced.

    The extra byte lets a later clip see that the file was longer.
    """
    return F.make_valid_utf8(F.substring(raw, 1, max_bytes + 1).cast("string"))


def log_tail(raw: Column, max_bytes: int = LOG_TAIL_BYTES) -> Column:
    """Trimmed text of the last ``max_bytes`` bytes of a log."""
    start = F.greatest(F.octet_length(raw) - max_bytes, F.lit(0)) + 1
    tail = F.substring(raw, start, F.lit(max_bytes))
    return py_strip(F.make_valid_utf8(tail.cast("string")))


def log_excerpt(raw: Column) -> Column:
    """The part of a log that goes into an error message."""
    return F.right(log_tail(raw), F.lit(LOG_TAIL_CHARS))
