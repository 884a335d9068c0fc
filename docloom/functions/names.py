"""File, path and archive-member names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which extensions are read directly, through an office reader,
# or expanded first.
CORE_EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".bmp", ".tif", ".tiff", ".webp")
OFFICE_EXTENSIONS = (".docx", ".pptx", ".xlsx")
ARCHIVE_SUFFIXES = (
    ".zip", ".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz",
)

CORE, OFFICE, ARCHIVE = "core", "office", "archive"


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def suffix(c: Column) -> Column:
    """Last extension with its dot; none for dotfiles and trailing dots."""
    return F.regexp_extract(c, r"[^/](\.[^./]+)\z", 1)


def extension(c: Column) -> Column:
    return F.lower(suffix(c))


def stem(c: Column) -> Column:
    name = base_name(c)
    return F.left(name, F.length(name) - F.length(suffix(name)))


def is_archive_name(c: Column) -> Column:
    name = F.lower(base_name(c))
    found = F.endswith(name, F.lit(ARCHIVE_SUFFIXES[0]))
    for s in ARCHIVE_SUFFIXES[1:]:
        found = found | F.endswith(name, F.lit(s))
    return found


def format_class(ext: Column) -> Column:
    """``core``, ``office``, ``archive`` or null for an unknown extension.

    The sets are closed and small, so a literal membership test replaces a join.
    """
    return (
        F.when(ext.isin(*CORE_EXTENSIONS), F.lit(CORE))
        .when(ext.isin(*ARCHIVE_SUFFIXES), F.lit(ARCHIVE))
        .when(ext.isin(*OFFICE_EXTENSIONS), F.lit(OFFICE))
    )


def _real_parts(c: Column) -> Column:
    return F.filter(F.split(c, "/"), lambda x: (x != "") & (x != "."))


def fold_path(c: Column) -> Column:
    """Absolute path without ``.``, ``..`` and repeated slashes."""
    folded = F.aggregate(
        _real_parts(c),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(
            x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).otherwise(F.concat(acc, F.array(x))),
    )
    tidy = F.concat(F.lit("/"), F.array_join(folded, "/"))
    return F.when(c.rlike(r"/\.{0,2}(/|\z)"), tidy).otherwise(c)


def within_roots(path: Column, roots: list[str]) -> Column:
    """True when a folded path is a root or lies under one; no roots, no paths."""
    inside = F.lit(False)
    for root in roots:
        root = root.rstrip("/")
        inside = inside | (path == F.lit(root or "/")) | F.startswith(path, F.lit(root + "/"))
    return inside


def member_parts(c: Column) -> Column:
    """Normalised name split at ``/``: the sort key of archive members."""
    return F.split(c, "/")


def member_name(c: Column) -> Column:
    """Relative form of a member name, without ``.`` parts and doubled slashes."""
    parts = _real_parts(F.translate(c, "\\", "/"))
    return F.when(F.size(parts) == 0, F.lit(".")).otherwise(F.array_join(parts, "/"))


def member_name_error(c: Column) -> Column:
    """Why a member name is refused, or null."""
    forward = F.translate(c, "\\", "/")
    quoted = F.concat(F.lit("entry `"), c)
    return (
        F.when(c.isNull() | c.isin("", ".", "./"), F.lit("an entry has no name"))
        .when(F.startswith(forward, F.lit("/")), F.concat(quoted, F.lit("` starts at the root")))
        .when(
            F.array_contains(F.split(forward, "/"), ".."),
            F.concat(quoted, F.lit("` leads out of its folder")),
        )
    )
