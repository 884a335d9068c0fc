"""Typed outcomes: an error code, a message, the dependencies that are missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import budget as B
from docloom.functions import names as N
from docloom.functions.text import is_blank

# The codes a failure can carry.
LIBRARY_MISSING = "library_missing"
MISSING_DEPENDENCY = "missing_dependency"
UNSUPPORTED_FORMAT = "unsupported_format"
PARSE_FAILED = "parse_failed"
INPUT_REJECTED = "input_rejected"
TIMEOUT = "timeout"

OFFICE_READER = "libreoffice"
OFFICE_MESSAGE = "office documents need a converter that this host does not have"
LIBRARY_MESSAGE = "the parser is not installed"
TIMEOUT_MESSAGE = "the parse exceeded its time budget"


def message(*parts: str | Column) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def failure(code: str | Column, text: str | Column, missing: str | None = None) -> Column:
    code = code if isinstance(code, Column) else F.lit(code)
    text = text if isinstance(text, Column) else F.lit(text)
    listed = F.array(F.lit(missing)) if missing else F.array().cast("array<string>")
    return F.struct(
        code.alias("error_code"), text.alias("error"), listed.alias("missing_dependencies")
    )


def preflight(name: Column, office_readable: bool = True) -> Column:
    """Format routing: null when the file may be parsed, else its failure."""
    ext = N.extension(name)
    kind = N.format_class(ext)
    shown = F.when(ext != "", ext).otherwise(N.base_name(name))
    unknown = failure(UNSUPPORTED_FORMAT, message("no reader for `", shown, "`"))
    if office_readable:
        return F.when(kind.isNull(), unknown)
    office = failure(MISSING_DEPENDENCY, OFFICE_MESSAGE, OFFICE_READER)
    return F.when(kind.isNull(), unknown).when(kind == N.OFFICE, office)


def exit_failure(name: Column, exit_code: Column, log: Column) -> Column:
    """A parser that ended with a non-zero code; null for zero."""
    tail = B.log_excerpt(log)
    text = message(
        "the parser exited with code ", exit_code.cast("string"), " on `", N.base_name(name), "`",
        F.when(tail != "", message(": ", tail)).otherwise(""),
    )
    return F.when(exit_code != 0, failure(PARSE_FAILED, text))


def no_output_failure(name: Column, log: Column) -> Column:
    """A parser that ended well and wrote no markdown."""
    tail = F.right(F.make_valid_utf8(log.cast("string")), F.lit(B.LOG_TAIL_CHARS))
    text = message(
        "the parser wrote no markdown for `", N.base_name(name), "`",
        F.when(~is_blank(tail), message(": ", tail)).otherwise(""),
    )
    return failure(PARSE_FAILED, text)


def empty_failure(name: Column) -> Column:
    return failure(
        PARSE_FAILED, message("the parser extracted no text from `", N.base_name(name), "`")
    )


def first_failure(*failures: Column) -> Column:
    """The earliest check that failed decides; null when all passed."""
    return F.coalesce(*failures)
