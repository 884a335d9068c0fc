"""Markup removal and whitespace rules as Column expressions.

The whitespace and line-break sets are wider than Java's ``\\s`` and ``$``, so
they are spelled out, and every pattern runs with Unix line mode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 29 characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The single characters that end a line besides "\n".
LINE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

LINE_BLANKS = "".join(c for c in WHITESPACE if c != "\n" and c not in LINE_BREAKS)

# The same sets as pattern classes.  A class with characters past Latin-1 is
# several times slower per character, so where one is tried at every character
# the ASCII form is used for text that has none of the others.
_W = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_BLANK = r"[\t\x1f \xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"
_ASCII_BLANK = r"[\t\x1f ]"


def _replace(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def py_strip(c: Column) -> Column:
    """Drop whitespace at both ends; linear, unlike an anchored pattern."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.length(py_strip(c)) == 0


# The possessive forms (``*+``, ``++``) match the same strings as the greedy
# ones wherever the next character cannot be part of the repeated class; they
# only remove backtracking.  The look-behind in ``strip_code_fences`` skips line
# starts inside a blank run whose first line start has already been tried.


def strip_code_fences(c: Column) -> Column:
    return _replace(c, f"(?md)^(?<!\\n\\n){_W}*+```.*$", "")


def _before_last(c: Column, mark: str, change: Callable[[Column], Column]) -> Column:
    """Changes the text up to the last ``mark`` and leaves the rest.

    For patterns that end with the mark: none can match later, and up to there each
    start finds an end, so no start scans the rest of the text in vain.
    """
    rest = F.substring_index(c, mark, -1)
    head = F.substring(c, F.lit(1), F.length(c) - F.length(rest))
    return F.concat(change(head), rest)


# A bracket that leads nowhere is taken with its whole run and put back: all brackets of
# the run end at the same place, so none of them leads anywhere either.


def strip_images(c: Column) -> Column:
    pattern = r"!\[([^\]]*+)\]\([^)]*+\)|(!\[[^\]]*+)"
    return _before_last(c, ")", lambda head: _replace(head, pattern, "$1$2"))


def strip_links(c: Column) -> Column:
    pattern = r"\[([^\]]*+)\]\([^)]*+\)|(\[[^\]]*+)"
    return _before_last(c, ")", lambda head: _replace(head, pattern, "$1$2"))


def strip_html_tags(c: Column) -> Column:
    return _before_last(c, ">", lambda head: _replace(head, r"<[^>]++>", " "))


def strip_headings(c: Column) -> Column:
    return _replace(c, f"(?md)^{_W}{{0,3}}#{{1,6}}{_W}++", "")


def strip_block_quotes(c: Column) -> Column:
    return _replace(c, f"(?md)^{_W}{{0,3}}>{_W}?", "")


def strip_bullets(c: Column) -> Column:
    return _replace(c, f"(?md)^{_W}{{0,3}}[-*+]{_W}++", "")


def strip_emphasis(c: Column) -> Column:
    """Every ``*``, ``_`` and back-tick goes, alone or doubled."""
    return F.translate(c, "*_`", "")


def _has_any(c: Column, marks: str | tuple[str, ...]) -> Column:
    found = F.contains(c, F.lit(marks[0]))
    for mark in marks[1:]:
        found = found | F.contains(c, F.lit(mark))
    return found


_WIDE = "".join(c for c in WHITESPACE if ord(c) > 127)


def _by_width(c: Column, pattern: Callable[[str], str]) -> Column:
    wide = (F.octet_length(c) != F.length(c)) & _has_any(c, _WIDE)
    return F.when(wide, _replace(c, pattern(_BLANK), "\n")).otherwise(
        _replace(c, pattern(_ASCII_BLANK), "\n")
    )


def fold_pairs(c: Column) -> Column:
    return F.replace(c, F.lit("\r\n"), F.lit("\n"))


def fold_breaks(c: Column) -> Column:
    return F.translate(c, LINE_BREAKS, "\n" * len(LINE_BREAKS))


def trim_lines(c: Column) -> Column:
    """Blanks before a newline go.

    The look-behind lets a run of blanks be tried from its first one only.
    """
    return _by_width(c, lambda blank: f"{blank}(?<!{blank}{blank}){blank}*+\\n")


def trim_line_ends(c: Column) -> Column:
    """Every line break becomes a newline and every line loses its end blanks."""
    return F.rtrim(trim_lines(fold_breaks(fold_pairs(c))), F.lit(LINE_BLANKS))


def squeeze_blank_lines(c: Column) -> Column:
    return _replace(c, "\n\n\n++", "\n\n")


# The order is part of the result: a later step sees what earlier ones left.
# Beside each step, what a text must contain for the step to change it.
PLAIN_TEXT_STEPS = (
    (strip_code_fences, ("```",)),
    (strip_images, ("![",)),
    (strip_links, ("](",)),
    (strip_html_tags, ("<",)),
    (strip_headings, ("#",)),
    (strip_block_quotes, (">",)),
    (strip_bullets, ("-", "*", "+")),
    (strip_emphasis, ("*", "_", "`")),
    (fold_pairs, ("\r\n",)),
    (fold_breaks, tuple(LINE_BREAKS)),
    (trim_lines, tuple(blank + "\n" for blank in LINE_BLANKS)),
    (squeeze_blank_lines, ("\n\n\n",)),
)


def with_plain_text(df: DataFrame, source: str, target: str) -> DataFrame:
    """Adds ``target``: the markup-free form of ``source``.

    One projection per step, so each step's text is a value that its guard and
    its pattern both read.  The guards are byte searches, far cheaper than the
    patterns; prose without markup passes through untouched.
    """
    df = df.withColumn(target, F.col(source))
    text = F.col(target)
    for step, marks in PLAIN_TEXT_STEPS:
        df = df.withColumn(target, F.when(_has_any(text, marks), step(text)).otherwise(text))
    return df.withColumn(target, py_strip(text))
