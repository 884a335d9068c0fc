"""Whole jobs: files in, one typed result per file out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import names as N
from docloom.functions import options as O
from docloom.functions.budget import lossy_text
from docloom.functions.text import py_strip
from docloom.limits import Limits
from docloom.operators import archive as A
from docloom.operators import intake as I
from docloom.operators import outcomes as X
from docloom.operators.hook import Parser, decode_text, parse_documents
from docloom.operators.results import shape_results
from docloom.session import staged
from docloom.sources import files, tree
from docloom.sources.containers import expand_archives, expand_files

RESULT_COLUMNS = ("path", "error_code", "error", "missing_dependencies", "result")


def _no_missing() -> Column:
    return F.array().cast("array<string>")


def _routed(df: DataFrame, office_readable: bool) -> DataFrame:
    """Adds the format outcome and drops the bytes of what will not be parsed."""
    return (
        df.withColumn("failure", X.preflight(F.col("name"), office_readable))
        .withColumn("content", F.when(F.col("failure").isNull(), F.col("content")))
        .withColumn("error_code", F.col("failure.error_code"))
        .withColumn("error", F.col("failure.error"))
        .withColumn(
            "missing_dependencies", F.coalesce("failure.missing_dependencies", _no_missing())
        )
        .drop("failure")
    )


@dataclass(frozen=True)
class Host:
    """What the host falls back to where a request leaves an option out."""

    backend: str | None = None
    lang: str | None = None
    device: str | None = None


def _with_options(df: DataFrame, options: str | None, host: Host) -> DataFrame:
    """Adds the cleaned ``options`` of each row and the ``parse_backend`` they choose.

    A column ``options`` (JSON text or VARIANT) speaks for its row; where it is null or
    absent the job's text does.
    """
    whole = F.try_parse_json(F.lit(options or "{}"))
    if "options" in df.columns:
        text = df.schema["options"].dataType.typeName() == "string"
        own = F.try_parse_json("options") if text else F.col("options")
        whole = F.when(F.col("options").isNull(), whole).otherwise(own)
    asked = df.withColumn("_asked", whole)
    cleaned = O.with_clean_options(asked, "_asked", host.backend, host.lang, host.device)
    return (
        cleaned.withColumn("options", O.options_json())
        .withColumn("parse_backend", F.col("opt_backend"))
        .drop("_asked", *[f"opt_{k}" for k in O.OPTION_NAMES])
    )


def _timed(parsed: DataFrame, limits: Limits) -> DataFrame:
    """A document that took longer than its budget has timed out, whatever it gave."""
    late = F.col("elapsed_ms") > 1000 * limits.timeout_secs
    return parsed.withColumns(
        {
            "error_code": F.when(late, X.TIMEOUT).otherwise(F.col("error_code")),
            "error": F.when(late, X.TIMEOUT_MESSAGE).otherwise(F.col("error")),
        }
    )


def _capped(parsed: DataFrame, max_bytes: int) -> DataFrame:
    """A parser's output is not trusted for size: one byte over the budget is kept,
    enough to see that it was longer."""
    raw = F.col("markdown").cast("binary")
    return parsed.withColumn("markdown", lossy_text(raw, max_bytes))


def parse_single(
    documents: DataFrame, limits: Limits, parser: Parser, office_readable: bool = True,
    options: str | None = None, host: Host = Host(), abreast: int = 1,
) -> DataFrame:
    """``path, content`` and perhaps ``options`` to results.  No shuffle: every step is
    row-local, so the same plan runs on a stream of files.  ``abreast``: see ``parse_documents``."""
    named = documents.withColumn("name", N.base_name(F.col("path")))
    routed = _routed(_with_options(named, options, host), office_readable)
    parsed = _capped(
        parse_documents(
            routed, ["path", "name", "missing_dependencies", "parse_backend"], parser, limits.timeout_secs,
            abreast=abreast,
        ),
        limits.max_output_bytes,
    )
    ready = (
        _timed(parsed, limits).withColumnRenamed("name", "filename")
        .withColumn("warnings", _no_missing())
        .withColumn("sources", F.array("filename"))
        .withColumn("over_budget", F.lit(False))
    )
    shaped = shape_results(ready, limits.max_output_bytes, limits.min_text_bytes)
    return shaped.select(*RESULT_COLUMNS)


def parse_archives(
    archives: DataFrame, limits: Limits, parser: Parser, office_readable: bool = True,
    options: str | None = None, host: Host = Host(),
) -> DataFrame:
    """``path, content`` and perhaps ``options`` of archives to one result each.

    With ``path, length`` in place of contents, tasks open the archive files themselves.
    Entries and parsed members are each written once; unsafe archives are out
    before anything of them is parsed.  The members of an archive share one time budget.
    """
    cap = limits.max_archive_members
    expand = expand_archives if "content" in archives.columns else expand_files
    entries = staged(expand(archives, cap, limits.max_archive_bytes), "entries")
    verdicts = staged(A.archive_verdicts(entries, cap, limits.max_archive_bytes), "verdicts")
    asked = archives.select(F.col("path").alias("archive"), *[c for c in archives.columns if c == "options"])
    safe = verdicts.where("error_code is null").select("archive").join(asked, "archive")
    named = (
        entries.where((F.col("ordinal") <= cap) & (F.col("kind") == A.FILE))
        .select("archive", "ordinal", N.member_name(F.col("name")).alias("name"))
        .join(safe, "archive")
    )
    members = A.last_copies(named, entries.select("archive", "ordinal", "content"))
    routed = _with_options(_routed(members, office_readable), options, host)
    parsed = parse_documents(routed, ["archive", "ordinal", "name"], parser, limits.timeout_secs)
    parsed = staged(
        A.with_body_bytes(_capped(_timed(parsed, limits), limits.max_output_bytes)), "parsed"
    )
    joined = A.assemble_archives(parsed, limits.max_output_bytes, cap, 1000 * limits.timeout_secs)
    empty = F.array().cast("array<string>")
    ready = (
        verdicts.select("archive", F.col("error_code").alias("refused_code"), F.col("error").alias("refused"))
        .join(joined, "archive", "left")
        .join(asked, "archive", "left")
        .select(
            F.col("archive").alias("path"),
            N.base_name(F.col("archive")).alias("filename"),
            F.coalesce("markdown", F.lit("")).alias("markdown"),
            F.coalesce("warnings", empty).alias("warnings"),
            F.coalesce("sources", empty).alias("sources"),
            "page_count",
            F.coalesce("over_budget", F.lit(False)).alias("over_budget"),
            F.coalesce("refused_code", "error_code").alias("error_code"),
            F.coalesce("refused", "error").alias("error"),
            _no_missing().alias("missing_dependencies"),
            *[c for c in archives.columns if c == "options"],
        )
    )
    chosen = _with_options(ready, options, host).drop("options")
    shaped = shape_results(chosen, limits.max_output_bytes, limits.min_text_bytes)
    return shaped.select(*RESULT_COLUMNS)


def _refused(listing: DataFrame, error_code: Column, error: Column, missing: Column, like: DataFrame) -> DataFrame:
    return listing.select(
        "path",
        error_code.alias("error_code"),
        error.alias("error"),
        missing.alias("missing_dependencies"),
        F.lit(None).cast(like.schema["result"].dataType).alias("result"),
    )


def _parse_files(
    found: DataFrame, limits: Limits, parser: Parser, office_readable: bool,
    options: str | None, host: Host,
) -> DataFrame:
    """``path, content`` and perhaps ``options`` of documents and archives to results."""
    packed = N.is_archive_name(F.col("path"))
    singles = parse_single(found.where(~packed), limits, parser, office_readable, options, host)
    archives = parse_archives(found.where(packed), limits, parser, office_readable, options, host)
    return singles.unionByName(archives)


def parse_inline(
    requests: DataFrame, limits: Limits = Limits(), parser: Parser = decode_text,
    office_readable: bool = True, options: str | None = None, host: Host = Host(),
) -> DataFrame:
    """Results of the accepted inline requests (``operators.intake.inline_files``)."""
    given = I.inline_files(requests, limits.max_input_bytes)
    if "options" in requests.columns:
        given = given.join(requests.select("request_id", "options"), "request_id")
    return _parse_files(given.drop("request_id"), limits, parser, office_readable, options, host)


def parse_requests(
    requests: DataFrame, listing: DataFrame, roots: list[str], limits: Limits = Limits(),
    parser: Parser = decode_text, office_readable: bool = True, options: str | None = None,
    host: Host = Host(),
) -> DataFrame:
    """One row per request: its result, or why there is none.

    ``requests``: ``request_id`` (one row each), ``path``, ``content_base64``, ``filename``
    and perhaps ``options``; ``listing``: ``path, length, content`` of the files under the
    roots.  A path that the listing lacks cannot be opened.
    """
    cap = limits.max_input_bytes
    real = N.fold_path(py_strip(F.col("path")))
    lengths = listing.select(F.col("path").alias("_real"), F.col("length").alias("_length"))
    sized = requests.withColumn("_real", real).join(lengths, "_real", "left")
    checked = I.check_requests(sized, roots, cap, F.col("_length"))
    by_path = F.col("accepted") & F.coalesce(F.length("path") > 0, F.lit(False))
    gone = by_path & F.col("_length").isNull()
    checked = staged(
        checked.withColumns(
            {
                "error_code": F.when(gone, X.INPUT_REJECTED).otherwise(F.col("error_code")),
                "error": F.when(gone, X.message("cannot open `", F.col("path"), "`")).otherwise(F.col("error")),
                "accepted": F.col("accepted") & ~gone,
            }
        ).drop("_length"),
        "requests",
    )
    # Each request gets a path of its own, as several may ask for one file.
    label = F.concat(F.lit("request/"), F.col("request_id").cast("string"), F.lit("/"))
    more = [c for c in requests.columns if c == "options"]
    passed = checked.where("accepted")
    opened = passed.where(F.length("path") > 0).select("request_id", "_real", *more).join(
        listing.select(F.col("path").alias("_real"), "content"), "_real"
    )
    opened = opened.select(
        F.concat(label, N.base_name(F.col("_real"))).alias("path"), "content", *more
    )
    sent = I.inline_files(passed, cap).join(passed.select("request_id", *more), "request_id")
    sent = sent.select(F.concat(label, N.base_name(F.col("path"))).alias("path"), "content", *more)
    results = _parse_files(opened.unionByName(sent), limits, parser, office_readable, options, host)
    kind = requests.schema["request_id"].dataType
    results = results.withColumn("request_id", F.split_part("path", F.lit("/"), F.lit(2)).cast(kind))
    refused = checked.where("not accepted").select("request_id", "error_code", "error").withColumns(
        {
            "missing_dependencies": _no_missing(),
            "result": F.lit(None).cast(results.schema["result"].dataType),
        }
    )
    return results.select(*refused.columns).unionByName(refused)


def parse_folder(
    spark: SparkSession, root: str, limits: Limits = Limits(), parser: Parser = decode_text,
    office_readable: bool = True, options: str | None = None, host: Host = Host(),
    asked: DataFrame | None = None, in_tasks: bool | None = None,
) -> DataFrame:
    """Results of all files under a folder: documents, archives and refusals.

    ``asked`` may give the options of single files (``path, options``).  Over-long files and
    unreadable formats are refused from the listing alone.  Tasks list and read the tree,
    names that start with ``_`` or ``.`` included; a link that leads out of ``root`` is
    refused, one that stays inside is read.  A root that tasks cannot open (``in_tasks``
    overrides the guess) goes through Spark's file source, and there such names are refused.
    """
    by_tasks = tree.opened_by_tasks(spark, root) if in_tasks is None else in_tasks
    judge = _listed_folder if by_tasks else _scanned_folder
    documents, packed, refusals = judge(spark, root, limits.max_input_bytes, office_readable)

    def with_asked(found: DataFrame) -> DataFrame:
        return found if asked is None else found.join(asked.select("path", "options"), "path", "left")

    singles = parse_single(with_asked(documents), limits, parser, office_readable, options, host)
    archives = parse_archives(with_asked(packed), limits, parser, office_readable, options, host)
    refused = _refused(
        refusals, F.col("refusal.error_code"), F.col("refusal.error"),
        F.col("refusal.missing_dependencies"), singles,
    )
    return singles.unionByName(archives).unionByName(refused)


def _refusal(cap: int, office_readable: bool) -> Column:
    """What the listing alone says against a file (``path, length``), or null."""
    name = N.base_name(F.col("path"))
    too_long = I.size_error(F.col("length"), cap)
    return F.coalesce(
        F.when(too_long.isNotNull(), X.failure(X.INPUT_REJECTED, too_long)),
        F.when(
            ~N.is_archive_name(name) & N.format_class(N.extension(name)).isNull(), X.preflight(name, office_readable)
        ),
    )


def _listed_folder(spark: SparkSession, root: str, cap: int, office_readable: bool) -> list[DataFrame]:
    """``path, content`` of documents, ``path, length`` of archives, ``path, refusal`` of the rest."""
    outside = tree.leads_out(spark, root)
    out = X.failure(X.INPUT_REJECTED, X.message("`", F.col("path"), "` leads out of its folder"))
    shut = X.failure(X.INPUT_REJECTED, X.message("cannot open `", F.col("path"), "`"))
    judged = tree.list_tree(spark, root).where(outside | ~tree.linked_folder()).withColumn(
        "refusal",
        F.coalesce(
            F.when(outside, out), F.when(~F.col("readable"), shut), _refusal(cap, office_readable)
        ),
    )
    kept, packed = judged.where("refusal is null").select("path", "length"), N.is_archive_name(F.col("path"))
    read = tree.read_tree(kept.where(~packed)).select("path", "content")
    return [read, kept.where(packed), judged.where("refusal is not null").select("path", "refusal")]


def _scanned_folder(spark: SparkSession, root: str, cap: int, office_readable: bool) -> list[DataFrame]:
    """The same through Spark's file source, archives with ``content``."""
    read = [scan(spark, root, cap).select("path", "content") for scan in (files.scan_documents, files.scan_archives)]
    unread = X.failure(
        X.INPUT_REJECTED, F.lit("a file or folder name that starts with `_` or `.` is not read")
    )
    refusals = (
        files.list_documents(spark, root)
        .withColumn("refusal", _refusal(cap, office_readable))
        .where("refusal is not null")
        .unionByName(files.hidden_files(spark, root).withColumn("refusal", unread))
    )
    return [*read, refusals.select("path", "refusal")]
