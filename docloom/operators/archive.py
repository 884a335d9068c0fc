"""Archive rules and ordered re-assembly.

Input rows are members: ``archive, ordinal, name, ...``.  ``ordinal`` is the
0-based place of the entry in its archive, so an archive with more than ``n``
entries is exactly one with a row at ordinal ``n``.  Rows past that one cannot
change any verdict and are filtered out before any shuffle, which bounds every
group at ``max_members + 1`` rows however large an archive is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import names as N
from docloom.functions.text import py_strip
from docloom.operators.outcomes import INPUT_REJECTED, TIMEOUT, message

# Kinds an entry can have.
FILE, DIRECTORY, SYMLINK, HARDLINK, SPECIAL = "file", "dir", "symlink", "hardlink", "special"
# Rows that are no entry: a container that could not be read on from this point,
# and one (at ordinal -1) without any entries.
UNREADABLE, EMPTY = "unreadable", "empty"

EMPTY_MEMBER = "parsed to an empty document"


def member_error(container: Column, name: Column, kind: Column) -> Column:
    """Why one entry makes its archive unsafe, or null."""
    quoted = message("entry `", name, "` is ")
    is_zip = container == "zip"
    link = kind.isin(SYMLINK, HARDLINK)
    return F.coalesce(
        N.member_name_error(name),
        F.when(is_zip & link, message(quoted, "a symbolic link"))
        .when(link, message(quoted, "a link to elsewhere"))
        .when(~is_zip & ~kind.isin(FILE, DIRECTORY), message(quoted, "no ordinary file")),
    )


def archive_verdicts(members: DataFrame, max_members: int, max_bytes: int) -> DataFrame:
    """One row per archive: entry and file counts, and why it is refused if it is.

    The first bad entry in archive order decides.  A zip lists its entries up
    front, so its count is checked before any of them.  Members may carry their
    own ``error_code`` and ``error`` from reading, which count after the rules.
    """
    if "error_code" not in members.columns:
        members = members.withColumns(
            {c: F.lit(None).cast("string") for c in ("error_code", "error")}
        )
    # Rows of names and sizes only; one task has listed the archive, so one can sort its list.
    in_order = Window.partitionBy("archive", "container").orderBy("ordinal").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    kind, is_tar = F.col("kind"), F.col("container") != "zip"
    running = F.sum(F.when(kind == FILE, F.col("declared_size")).otherwise(0)).over(in_order)
    reason = F.coalesce(
        F.when(
            is_tar & (F.col("ordinal") >= max_members),
            F.lit(f"archive lists more than {max_members} members"),
        ),
        member_error(F.col("container"), F.col("name"), kind),
        F.when(
            (kind == FILE) & (F.col("running") > max_bytes),
            F.lit(f"archive unpacks beyond the {max_bytes}-byte limit"),
        ),
    )
    first = F.when(
        F.col("reason").isNotNull(), F.struct(F.lit(INPUT_REJECTED).alias("code"), "reason")
    ).when(
        F.col("error_code").isNotNull(),
        F.struct(F.col("error_code").alias("code"), F.col("error").alias("reason")),
    )
    summed = (
        members.select(
            "archive", "container", "ordinal", "name", "kind", "declared_size", "error_code", "error"
        )
        .withColumn("running", running)
        .withColumn("reason", F.when(~kind.isin(UNREADABLE, EMPTY), reason))
        .withColumn("first", F.when(F.col("ordinal") <= max_members, first))
        .groupBy("archive", "container")
        .agg(
            (F.max("ordinal") + 1).cast("bigint").alias("n_entries"),
            F.count_if(kind == FILE).alias("n_files"),
            F.min_by("first", F.when(F.col("first").isNotNull(), F.col("ordinal"))).alias("first"),
        )
    )
    too_many = F.when(
        ~is_tar & (F.col("n_entries") > max_members),
        message(
            "archive lists ", F.col("n_entries").cast("string"),
            f" entries, over the {max_members} limit",
        ),
    )
    return (
        summed.withColumn("error", F.coalesce(too_many, F.col("first.reason")))
        .withColumn(
            "error_code", F.when(too_many.isNotNull(), INPUT_REJECTED).otherwise(F.col("first.code"))
        )
        .select("archive", "container", "n_entries", "n_files", "error_code", "error")
    )


def last_copies(
    named: DataFrame, contents: DataFrame | None = None, value: str = "content"
) -> DataFrame:
    """Every copy of a repeated name gets the value of the last copy.

    ``named`` has ``archive, ordinal, name`` and what else is slim; ``contents`` has
    ``archive, ordinal`` and the value (by default both are in one frame).  Which copy is
    the last is found on slim rows; the values are dealt out once, by archive and ordinal,
    which also spreads one archive's members over all tasks, and are never sorted.
    """
    source = named if contents is None else contents
    copies = Window.partitionBy("archive", "name")
    slim = named.drop(value).withColumn("_last", F.max("ordinal").over(copies))
    values = source.select("archive", F.col("ordinal").alias("_last"), value)
    return values.join(slim.hint("shuffle_hash"), ["archive", "_last"]).drop("_last")


def with_body_bytes(members: DataFrame) -> DataFrame:
    """Adds the size of each member's trimmed text, unless a stage has stored it.

    With it stored, deciding what fits does not read any text.
    """
    if "body_bytes" in members.columns:
        return members
    return members.withColumn("body_bytes", F.octet_length(py_strip(F.col("markdown"))))


def _note() -> Column:
    """The warning a member gives instead of a section, or null."""
    return F.when(
        F.col("error_code").isNotNull(), message(F.col("name"), ": ", F.col("error"))
    ).when(
        F.coalesce(F.col("body_bytes"), F.lit(0)) == 0,
        message(F.col("name"), f": {EMPTY_MEMBER}"),
    )


def assembly_plan(
    members: DataFrame, budget: int, max_members: int, timeout_ms: int | None = None
) -> DataFrame:
    """What goes into each archive's result, decided without moving any text.

    With ``timeout_ms`` the ``elapsed_ms`` of the members add up in path order, and an
    archive is late when they pass it before the budget cut.

    Members count in path order.  A section costs its bytes plus two for the
    blank line after it; members without one cost nothing.  The running cost
    never falls, so "running cost within budget" is the same set as "stop at the
    first section that does not fit".
    """
    note = F.col("note")
    cost = F.octet_length("name") + F.col("body_bytes") + 6
    slim = (
        with_body_bytes(members)
        .where(F.col("ordinal") <= max_members)
        .withColumn("note", _note())
        .select(
            "archive", "ordinal", "name", "page_count", "error_code", "note",
            (F.col("elapsed_ms") if timeout_ms is not None else F.lit(0)).alias("elapsed_ms"),
            N.member_parts(F.col("name")).alias("parts"),
            F.when(note.isNull(), cost).otherwise(0).cast("bigint").alias("cost"),
        )
    )
    by_path = Window.partitionBy("archive").orderBy("parts", "ordinal").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    kept = F.col("reached") & note.isNull()
    late = F.col("error_code") == TIMEOUT
    rows = slim.withColumn("reached", F.sum("cost").over(by_path) <= budget)
    if timeout_ms is not None:
        rows = rows.withColumn("spent", F.sum("elapsed_ms").over(by_path))
        late = late | (F.col("spent") > timeout_ms)

    def listed(keep: Column, field: str) -> Column:
        picked = F.collect_list(F.when(keep, F.struct("parts", "ordinal", field)))
        return F.transform(F.array_sort(picked), lambda x: x[field])

    skipped = F.col("n_members") - F.col("n_reached")
    return (
        rows.withColumn("slot", F.col("ordinal"))
        .groupBy("archive")
        .agg(
            F.count("*").alias("n_members"),
            F.count_if("reached").alias("n_reached"),
            (F.max("ordinal") >= max_members).alias("over_cap"),
            F.nullif(F.sum(F.when(kept, F.col("page_count"))), F.lit(0).cast("bigint")).alias(
                "page_count"
            ),
            F.bool_or(F.col("reached") & F.coalesce(late, F.lit(False))).alias("timed_out"),
            listed(kept, "slot").alias("kept"),
            listed(kept, "name").alias("sources"),
            listed(F.col("reached") & note.isNotNull(), "note").alias("notes"),
        )
        .withColumn("over_budget", skipped > 0)
        .withColumn(
            "warnings",
            F.concat(
                "notes",
                F.when(
                    skipped > 0,
                    F.array(
                        message(
                            "no room for more: ", skipped.cast("string"), " of ",
                            F.col("n_members").cast("string"),
                            " entries are left out",
                        )
                    ),
                ).otherwise(F.array().cast("array<string>")),
            ),
        )
        .drop("notes")
    )


def assemble_archives(
    members: DataFrame, budget: int, max_members: int, timeout_ms: int | None = None
) -> DataFrame:
    """One row per archive with its joined markdown, warnings and sources.

    ``members``: ``archive, ordinal, name, markdown, page_count, error_code,
    error``.  The kept sections are listed with their places; text meets that list by
    archive and ordinal, so what is not kept is dropped before anything is gathered, and
    only sections within the budget meet in a task.
    """
    plan = assembly_plan(members, budget, max_members, timeout_ms)
    places = plan.where(~F.col("over_cap")).select(
        "archive", F.posexplode("kept").alias("place", "ordinal")
    )
    section = message("# ", F.col("name"), "\n\n", py_strip(F.col("markdown")))
    text = members.where((F.col("ordinal") <= max_members) & F.col("error_code").isNull()).select(
        "archive", "ordinal", section.alias("section")
    )
    kept = text.join(places, ["archive", "ordinal"])
    joined = kept.groupBy("archive").agg(
        F.array_sort(F.collect_list(F.struct("place", "section"))).alias("sections")
    )
    refused = F.col("over_cap")
    body = F.array_join(F.transform("sections", lambda x: x["section"]), "\n\n")
    return plan.join(joined, "archive", "left").select(
        "archive",
        F.coalesce(body, F.lit("")).alias("markdown"),
        "warnings",
        "sources",
        F.col("page_count").cast("bigint").alias("page_count"),
        "over_budget",
        "n_members",
        F.when(refused, INPUT_REJECTED).when(F.col("timed_out"), TIMEOUT).alias("error_code"),
        F.when(refused, F.lit(f"archive lists more than {max_members} members"))
        .when(F.col("timed_out"), F.lit("the parse exceeded its time budget"))
        .alias("error"),
    )
