"""Registered queries: each runs one operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import budget as B
from docloom.functions import names as N
from docloom.functions import options as O
from docloom.functions import payload as P
from docloom.functions import text as T
from docloom.limits import MIB, Limits
from docloom.operators import archive as A
from docloom.operators import intake as I
from docloom.operators import ledger as L
from docloom.operators import outcomes as X
from docloom.operators import outputs as G
from docloom.operators import results as R
from docloom.operators.hook import decode_text
from docloom.plans import inputs as inp
from docloom.plans.collect_outputs import collect_outputs as collect_tree
from docloom.plans.parse_job import parse_archives, parse_single
from docloom.plans.parse_job import parse_requests as run_requests
from docloom.session import stage_path
from docloom.sources import files, sinks, tree
from docloom.sources.containers import expand_archives, expand_files, register_expand_archive
from docloom.streaming.documents import many_files, shape_stream, write_stream, write_streams
from docloom.streaming.jobs import compact_folds, latest_jobs, start_job_fold
from docloom.streaming.timers import current_jobs, start_job_timers

Query = Callable[[SparkSession, str], DataFrame]

ROOTS = [f"/data/src{i}" for i in (0, 1, 2, 3, 5, 8, 13)]
MAX_INPUT = 20_000
CAP_BYTES = 3_000
ARCHIVE_BUDGET = 60_000
# An archive of the derived inputs is a block of at most this many documents.
MAX_MEMBERS = inp.ARCHIVE_BLOCK
CLIP = 200
SHARED_BUDGET, SHARED_MIN_TEXT = 3_000, 500
TIMEOUT_SECS, RETAINED_SECS = 600, 86_400
# One document in so many hangs, the next one's parser dies.
ODD_PARSES, HANG_SECS = 389, 3
# A parser that hangs only waits: so many may in a task before it has to.
HANGS_ABREAST = 8
CEILING = 30_000
FILE_FOLDERS = 256
# Any name of a folder fits one of them.
FOLDER_SHARES = ("*[01]", "*[23]", "*[45]", "*[67]", "*[!0-7]")
# Files of a lot, and lots that streams take side by side: the driver knows each file by name while they run.
LOT_FILES, LOTS_ABREAST = 100_000, 2
# Files of output trees on disk at a time; where there are more, those of a part, which is gone
# before the system writes its files out and so is removed in a fraction of the time.
TREE_FILES, PART_FILES = 1_000_000, 200_000
# Bounded ledgers: the default of 64, and one larger than the live jobs.
MAX_JOBS, MAX_JOBS_WIDE = 64, 2_500


# --- intake -----------------------------------------------------------------


def intake_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = I.check_requests(inp.requests(spark, sf_dir), ROOTS, MAX_INPUT, F.col("size"))
    return checked.select("request_id", "accepted", "error_code", "error")


def inline_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inp.requests(spark, sf_dir).where(F.length("content_base64") > 0)
    raw = P.decode_inline(F.col("content_base64"))
    return given.withColumn("raw", raw).select(
        "request_id",
        F.col("raw").isNotNull().alias("valid"),
        F.octet_length("raw").cast("bigint").alias("n_bytes"),
        P.inline_size(F.col("content_base64")).alias("size_from_text"),
        P.inline_suffix(F.col("filename")).alias("suffix"),
        F.md5("raw").alias("digest"),
    )


def root_confinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = inp.requests(spark, sf_dir).where(F.length("path") > 0).select(
        "request_id", N.fold_path(F.col("path")).alias("path")
    )
    return folded.where(N.within_roots(F.col("path"), ROOTS))


def size_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = inp.table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("size")
    )
    return sized.select("doc_id", "size", I.size_error(F.col("size"), CAP_BYTES).alias("error"))


def format_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = inp.table(spark, sf_dir, "documents").select("doc_id", inp.file_name().alias("name"))
    name = F.col("name")
    return named.withColumn("failure", X.preflight(name, office_readable=False)).select(
        "doc_id",
        "name",
        N.extension(name).alias("ext"),
        N.stem(name).alias("stem"),
        N.is_archive_name(name).alias("is_archive"),
        N.format_class(N.extension(name)).alias("format_class"),
        F.col("failure.error_code").alias("error_code"),
        F.col("failure.error").alias("error"),
        F.array_join("failure.missing_dependencies", ",").alias("missing"),
    )


def option_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = inp.option_requests(spark, sf_dir)
    return O.with_clean_options(asked, "options", host_lang="en", host_device="cpu").drop("options")


def outcome_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc, name = F.col("doc_id"), F.col("name")
    rejected = I.size_error(F.octet_length("text"), MAX_INPUT)
    log = F.col("text").cast("binary")
    failure = X.first_failure(
        F.when(rejected.isNotNull(), X.failure(X.INPUT_REJECTED, rejected)),
        X.preflight(name, office_readable=False),
        F.when(doc % 23 == 1, X.failure(X.LIBRARY_MISSING, X.LIBRARY_MESSAGE)),
        F.when(doc % 19 == 1, X.failure(X.TIMEOUT, X.TIMEOUT_MESSAGE)),
        X.exit_failure(name, F.when(doc % 17 == 1, 2).otherwise(0), log),
        F.when(doc % 13 == 1, X.empty_failure(name)),
    )
    docs = inp.table(spark, sf_dir, "documents").withColumn("name", inp.file_name())
    return docs.withColumn("failure", failure).select(
        "doc_id",
        F.coalesce("failure.error_code", F.lit("ok")).alias("outcome"),
        F.col("failure.error").alias("error"),
        F.array_join("failure.missing_dependencies", ",").alias("missing"),
    )


# --- archives ---------------------------------------------------------------


def member_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return inp.entries(spark, sf_dir, with_text=False).select(
        "doc_id",
        "archive",
        N.member_name(name).alias("relative"),
        A.member_error(F.col("container"), name, F.col("kind")).alias("error"),
    )


def archive_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.archive_verdicts(inp.entries(spark, sf_dir, with_text=False), max_members=49, max_bytes=90_000)


def archive_bytes_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.archive_verdicts(inp.entries(spark, sf_dir, with_text=False), max_members=MAX_MEMBERS, max_bytes=90_000)


def repeated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = inp.entries(spark, sf_dir).select(
        "archive", "ordinal", F.concat("lang", F.lit("/page.pdf")).alias("name"), F.col("text").alias("content")
    )
    return A.last_copies(named).select(
        "archive", "ordinal", "name", F.md5(F.col("content").cast("binary")).alias("digest")
    )


def _flat(archives: DataFrame) -> DataFrame:
    return archives.select(
        "archive",
        "markdown",
        F.array_join("warnings", "\n").alias("warnings"),
        F.array_join("sources", "\n").alias("sources"),
        "page_count",
        "over_budget",
        "n_members",
        "error_code",
        "error",
    )


def archive_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = inp.parsed_members(spark, sf_dir)
    return _flat(A.assemble_archives(members, ARCHIVE_BUDGET, MAX_MEMBERS))


def archive_uncut(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = inp.parsed_members(spark, sf_dir)
    return _flat(A.assemble_archives(members, 8 * MIB, MAX_MEMBERS))


def archive_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: members to one shaped result per archive."""
    members = inp.parsed_members(spark, sf_dir)
    assembled = A.assemble_archives(members, ARCHIVE_BUDGET, MAX_MEMBERS)
    ready = assembled.withColumn("filename", F.concat("archive", F.lit(".zip"))).withColumn(
        "missing_dependencies", F.array().cast("array<string>")
    ).withColumn("parse_backend", F.lit(O.DEFAULT_BACKEND))
    shaped = R.shape_results(ready, ARCHIVE_BUDGET, SHARED_MIN_TEXT)
    return flat_results(shaped.select("archive", "error_code", "error", "result"))


def flat_results(shaped: DataFrame) -> DataFrame:
    rest = [c for c in shaped.columns if c != "result"]
    return shaped.select(
        *rest,
        F.col("result.markdown").alias("markdown"),
        F.col("result.text").alias("text"),
        F.array_join("result.warnings", "\n").alias("warnings"),
        F.col("result.truncated").alias("truncated"),
        F.col("result.metadata.filename").alias("filename"),
        F.col("result.metadata.page_count").alias("page_count"),
        F.array_join("result.metadata.sources", "\n").alias("sources"),
        F.col("result.metadata.parse_backend").alias("parse_backend"),
    )


# --- text -------------------------------------------------------------------


def _text_query(step: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = inp.markdown_documents(spark, sf_dir)
        return docs.select("doc_id", step(F.col("markdown")).alias("result"))

    return run


TEXT_STEPS = {
    "strip_code_fence": T.strip_code_fences,
    "strip_image": T.strip_images,
    "strip_link": T.strip_links,
    "strip_html_tag": T.strip_html_tags,
    "strip_heading": T.strip_headings,
    "strip_block_quote": T.strip_block_quotes,
    "strip_bullet": T.strip_bullets,
    "strip_emphasis": T.strip_emphasis,
    "trim_line_ends": T.trim_line_ends,
    "squeeze_blank_lines": T.squeeze_blank_lines,
    "strip_ends": T.py_strip,
}


def plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inp.markdown_documents(spark, sf_dir).select("doc_id", "markdown")
    return T.with_plain_text(docs, "markdown", "result").select("doc_id", "result")


def plain_text_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inp.table(spark, sf_dir, "pages").select("page_id", "html")
    return T.with_plain_text(pages, "html", "result").select("page_id", "result")


def clip_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inp.table(spark, sf_dir, "documents").select(
        "doc_id",
        B.clip_bytes(F.col("text"), CLIP).alias("clipped"),
        B.fits(F.col("text"), CLIP).alias("whole"),
    )


def shared_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inp.markdown_documents(spark, sf_dir).select("doc_id", "markdown")
    shaped = R.share_budget(docs, SHARED_BUDGET, SHARED_MIN_TEXT)
    return shaped.select("doc_id", "markdown", "text", "whole_markdown", "whole_text")


def error_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = F.col("text").cast("binary")
    return inp.table(spark, sf_dir, "documents").select(
        "doc_id", B.log_tail(log).alias("tail"), B.log_excerpt(log).alias("excerpt")
    )


def lossy_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inp.table(spark, sf_dir, "documents").select(
        "doc_id", B.lossy_text(F.col("text").cast("binary"), CLIP).alias("read")
    )


def result_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    failure = X.preflight(F.col("filename"), office_readable=False)
    docs = (
        inp.markdown_documents(spark, sf_dir)
        .withColumn("filename", inp.file_name())
        .withColumn("failure", failure)
        .select(
            "doc_id",
            "filename",
            F.when(doc % 29 == 0, F.lit("\n\t ")).otherwise(F.col("markdown")).alias("markdown"),
            F.array(F.concat(F.lit("checked "), "lang")).alias("warnings"),
            F.array("filename").alias("sources"),
            F.when(doc % 4 != 0, doc % 4).alias("page_count"),
            F.lit(False).alias("over_budget"),
            F.lit(O.DEFAULT_BACKEND).alias("parse_backend"),
            "failure.error_code",
            "failure.error",
            "failure.missing_dependencies",
        )
    )
    shaped = R.shape_results(docs, SHARED_BUDGET, SHARED_MIN_TEXT)
    return flat_results(shaped.select("doc_id", "error_code", "error", "result"))


# --- parser outputs ---------------------------------------------------------


def pick_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.pick_markdown(inp.candidates(spark, sf_dir))


def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.page_count(inp.content_lists(spark, sf_dir))


def page_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = G.page_window(inp.content_lists(spark, sf_dir), 0, 40)
    return window.select("parse_id", "file", F.col("item_no").cast("bigint"), "page_idx")


def no_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = inp.candidates(spark, sf_dir)
    return G.missing_output(inp.parses(spark, sf_dir), G.pick_markdown(written))


# --- job ledger -------------------------------------------------------------


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.job_snapshots(inp.job_events(spark, sf_dir))


def _told_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.job_snapshots(inp.told_job_events(spark, sf_dir))


def _flat_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("missing_dependencies", F.array_join("missing_dependencies", ","))


def job_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_jobs(_told_jobs(spark, sf_dir))


def job_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = _jobs(spark, sf_dir).withColumn("result", F.concat(F.lit("result of "), "job_id"))
    return L.job_listing(jobs)


def job_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inp.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("job_id"))
    return L.job_lookup(wanted, _jobs(spark, sf_dir))


def job_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return _flat_jobs(L.apply_deadline(_told_jobs(spark, sf_dir), now, TIMEOUT_SECS))


def job_cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inp.job_events(spark, sf_dir)
    ask = F.col("status") == "cancelled"
    jobs = L.job_snapshots(events.where(~ask))
    return L.apply_cancels(jobs, events.where(ask).select("job_id", "ts"))


def job_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.retain_jobs(_jobs(spark, sf_dir), MAX_JOBS_WIDE)


def job_retention_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.retain_jobs(_jobs(spark, sf_dir), MAX_JOBS)


# --- files, containers, parser hook -----------------------------------------


def _document_files(spark: SparkSession, sf_dir: str, lots: int | None = None) -> str:
    """A tree with one text file per document row, a line each, spread over so many folders.

    With ``lots``, so many trees beside one another share the files evenly.
    """
    root = stage_path(spark, "document-files")
    docs = inp.table(spark, sf_dir, "documents").select("doc_id", "text")
    if tree.opened_by_tasks(spark, root):
        # Rows of one id have a file each; a task that is run again writes the same names.
        docs = docs.withColumn("row", F.monotonically_increasing_id())
        folder = F.pmod(F.xxhash64("doc_id"), F.lit(FILE_FOLDERS))
        name = F.format_string("part=%d/doc_id=%d.%d.txt", folder, "doc_id", "row")
        if lots is not None:
            # By row as well, as one id may have any number of them.
            lot = F.pmod(F.xxhash64("row", "doc_id"), F.lit(lots))
            name = F.concat(F.format_string("lot=%d/", lot), name)
        line = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
        tree.write_tree(docs.select(name.alias("file"), line.cast("binary").alias("content")), root)
    else:
        docs.write.partitionBy("doc_id").text(root)
    return root


def _file_digests(found: DataFrame) -> DataFrame:
    doc = F.regexp_extract("path", r"doc_id=(-?\d+)[./]", 1).try_cast("bigint")
    return found.select(doc.alias("doc_id"), "length", F.md5("content").alias("digest"))


def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written from all documents, scanned back with their lengths and bytes."""
    root = _document_files(spark, sf_dir)
    return _file_digests(files.scan(spark, root, "*.txt", in_tasks=tree.opened_by_tasks(spark, root)))


def document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as streams of arrivals, some hundred a batch, each of a share of the folders.

    A file source keeps the name of every file it has seen on the driver, so the files come in
    lots of about ``LOT_FILES``, and the streams of some lots end before those of the next begin.
    """
    lots = max(1, -(-inp.table(spark, sf_dir, "documents").count() // LOT_FILES))
    root = _document_files(spark, sf_dir, lots)
    places = [[root]]
    if tree.opened_by_tasks(spark, root):
        abreast = [range(n, min(n + LOTS_ABREAST, lots)) for n in range(0, lots, LOTS_ABREAST)]
        places = [[f"{root}/lot={n}/{s}" for n in some for s in FOLDER_SHARES] for some in abreast]
    out, log = stage_path(spark, "document-stream"), stage_path(spark, "document-stream-log")
    found = []
    with many_files(spark):
        for n, shares in enumerate(places):
            arriving = [files.stream_documents(spark, s, "*.txt", files_per_batch=400) for s in shares]
            found.append(write_streams([_file_digests(a) for a in arriving], f"{out}/lots={n}", f"{log}/lots={n}"))
    return reduce(DataFrame.unionAll, found)


def collect_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output trees of parses, written as files in hidden folders and scanned back, to results:
    markdown, page counts and failures.

    A small file takes a block of the disk and a folder one more, so a parse has one hidden
    folder besides those its files name, and more than ``TREE_FILES`` files come in parts of
    about ``PART_FILES``; a part's tree goes once its results are written.  The parts share a
    root: a file system puts the folders of a new one beside those just removed, and there each
    new file searches past all that went.
    """
    outputs, parses = inp.output_files(spark, sf_dir), inp.parses(spark, sf_dir)
    n_files = outputs.count()
    parts = 1 if n_files <= TREE_FILES else -(-n_files // min(TREE_FILES, PART_FILES))
    folder = F.concat(F.lit("_run"), F.col("parse_id").cast("string"))
    number = F.substring("parse_id", len("_run") + 1, 20).cast("bigint")
    inside = F.concat(folder, F.lit("/"), "file")
    root, results, schema = stage_path(spark, "parse-outputs"), stage_path(spark, "parse-results"), None
    # However few files hold the tables, all cores write trees, each of them whole.
    tasks = spark.sparkContext.defaultParallelism * 4
    for n in range(parts):
        mine = F.pmod(F.xxhash64(F.col("parse_id").cast("bigint")), F.lit(parts)) == n
        written, asked = outputs.where(mine), parses.where(mine)
        dealt = written.repartition(tasks, "parse_id")
        tree.write_tree(dealt.select(inside.alias("file"), "content"), root)
        asked = asked.withColumn("parse_id", folder)
        found = collect_tree(spark, root, asked, Limits(max_output_bytes=SHARED_BUDGET)).withColumn("parse_id", number)
        schema = found.schema
        found.write.parquet(f"{results}/part={n}")
        if parts > 1:
            tree.remove_folders(written.select(folder.alias("folder")).distinct(), root)
    return spark.read.schema(schema).parquet(*[f"{results}/part={n}" for n in range(parts)])


def parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by path and inline, with options of their own, to results or refusals."""
    limits = Limits(
        max_input_bytes=MAX_INPUT, max_output_bytes=SHARED_BUDGET, min_text_bytes=SHARED_MIN_TEXT
    )
    results = run_requests(
        inp.job_requests(spark, sf_dir), inp.listed_files(spark, sf_dir), ["/data"], limits,
        decode_text, office_readable=False,
    )
    return flat_results(results.drop("missing_dependencies"))


def output_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as output of 32 parses, one folder each, and scanned back."""
    root = stage_path(spark, "outputs")
    pages = inp.table(spark, sf_dir, "pages").select(
        (F.col("page_id") % 32).alias("parse"), F.regexp_replace("html", r"[\r\n]+", " ").alias("value")
    )
    pages.write.partitionBy("parse").text(root)
    found = files.scan_outputs(spark, root, "*.txt")
    return found.groupBy("parse_id").agg(F.sum("size").alias("n_bytes"))


def archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = expand_archives(inp.packed_archives(spark, sf_dir), MAX_MEMBERS)
    return entries.select(
        "archive", "container", "ordinal", "name", "kind", "declared_size",
        F.md5("content").alias("digest"), "error",
    )


def archive_expand_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from archive files, whose members are dealt out before they are read."""
    root = stage_path(spark, "archive-files")
    tree.write_tree(inp.packed_archives(spark, sf_dir).select(F.concat(F.lit("_in"), "path").alias("file"), "content"), root)
    entries = expand_files(tree.list_tree(spark, root), MAX_MEMBERS)
    return entries.select(
        F.substring_index("archive", root + "/_in", -1).alias("archive"),
        "container", "ordinal", "name", "kind", "declared_size", F.md5("content").alias("digest"), "error",
    )


def archive_expand_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a table function."""
    register_expand_archive(spark)
    return spark.sql(
        """SELECT f.path AS archive, e.container, e.ordinal, e.name, e.kind, e.declared_size,
                  md5(e.content) AS digest, e.error
           FROM {packed} f, LATERAL expand_archive(f.path, f.content, {members}) e""",
        packed=inp.packed_archives(spark, sf_dir),
        members=MAX_MEMBERS,
    )


def parse_job_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inp.markdown_documents(spark, sf_dir).select(
        F.concat(F.lit("/data/"), "source", F.lit("/"), inp.file_name()).alias("path"),
        F.col("markdown").cast("binary").alias("content"),
    )
    limits = Limits(max_output_bytes=SHARED_BUDGET, min_text_bytes=SHARED_MIN_TEXT)
    return flat_results(parse_single(docs, limits, decode_text, office_readable=False).drop("missing_dependencies"))


def _odd_parser():
    """Decodes, but for some documents: one kind hangs for good, one takes its process along."""

    def parser(name, content, options):
        import os
        import sys
        import time

        number = int(name.split(".")[0][1:])
        if number % ODD_PARSES == 0:
            time.sleep(3600)
        if number % ODD_PARSES == 1:
            print(f"cannot go on with {number}", file=sys.stderr, flush=True)
            os._exit(3)
        return content.decode("utf-8", errors="replace"), None

    return parser


def parse_job_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parser that hangs or dies on some documents; all others get their results."""
    docs = inp.markdown_documents(spark, sf_dir).select(
        F.concat(F.lit("/data/"), "source", F.lit("/"), inp.file_name()).alias("path"),
        F.col("markdown").cast("binary").alias("content"),
    )
    limits = Limits(max_output_bytes=SHARED_BUDGET, min_text_bytes=SHARED_MIN_TEXT, timeout_secs=HANG_SECS)
    tasks = max(8, 2 * spark.sparkContext.defaultParallelism)
    results = parse_single(
        docs.repartition(tasks, "path"), limits, _odd_parser(), office_readable=False, abreast=HANGS_ABREAST
    )
    return flat_results(results.drop("missing_dependencies"))


def archive_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members are read until the archive has expanded past its ceiling."""
    entries = expand_archives(inp.packed_archives(spark, sf_dir), MAX_MEMBERS, CEILING)
    return entries.select("archive", "ordinal", "name", F.md5("content").alias("digest"), "error_code")


def parse_job_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = Limits(
        max_output_bytes=ARCHIVE_BUDGET, min_text_bytes=SHARED_MIN_TEXT, max_archive_members=MAX_MEMBERS
    )
    results = parse_archives(inp.packed_archives(spark, sf_dir), limits, decode_text, office_readable=False)
    return flat_results(results.drop("missing_dependencies"))


def result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written by status; the listing reads everything but the payload."""
    docs = inp.markdown_documents(spark, sf_dir).select(
        F.concat(F.lit("/data/"), "source", F.lit("/"), inp.file_name()).alias("path"), "markdown"
    )
    path = stage_path(spark, "results")
    sinks.write_results(sinks.with_status(shape_stream(docs, office_readable=False)), path)
    return sinks.read_listing(spark, path).select("path", "status", "error_code")


def result_sink_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results committed in a batch per language, one of them run again: each row once."""
    docs = inp.markdown_documents(spark, sf_dir).select(
        "lang", F.concat(F.lit("/data/"), "source", F.lit("/"), inp.file_name()).alias("path"), "markdown"
    )
    path = stage_path(spark, "results-committed")
    langs = [r.lang for r in docs.select("lang").distinct().orderBy("lang").collect()]
    for n, lang in enumerate([*langs, *langs[:1]]):
        part = docs.where(F.col("lang").eqNullSafe(F.lit(lang))).drop("lang")
        done = sinks.with_status(shape_stream(part, office_readable=False))
        sinks.commit_results(done, path, f"lang-{n % len(langs)}")
    return sinks.read_committed(spark, path, done.schema).select("path", "status", "error_code")


# --- streams ----------------------------------------------------------------


def doc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = inp.table(spark, sf_dir, "documents").schema
    # A pattern, since a table may be one file or a folder of files.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parquet*").select(
        "doc_id",
        F.concat(F.lit("/data/"), "source", F.lit("/"), inp.file_name()).alias("path"),
        inp.markdown().alias("markdown"),
    )
    limits = Limits(max_output_bytes=SHARED_BUDGET, min_text_bytes=SHARED_MIN_TEXT)
    out = stage_path(spark, "doc-stream")
    shaped = shape_stream(arriving, limits, office_readable=False)
    write_stream(shaped, out, stage_path(spark, "doc-stream-log")).awaitTermination()
    return flat_results(spark.read.parquet(out).select("doc_id", "error_code", "error", "result"))


def _arriving(spark: SparkSession, batches: list[DataFrame]) -> DataFrame:
    """A stream over files written one frame after the other, two a batch."""
    inbox = stage_path(spark, "job-events")
    for part in batches:
        part.write.mode("append").parquet(inbox)
    files_of = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 2)
    return inp.as_job_events(files_of.parquet(inbox))


def _without_zone(jobs: DataFrame) -> DataFrame:
    return jobs.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "started_at", "finished_at")}
    )


def job_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in shuffled order over several batches; the result is the fold of them all."""
    events = inp.table(spark, sf_dir, "events")
    arriving = _arriving(spark, [events.repartition(6, F.xxhash64("event_id"))])
    out = stage_path(spark, "job-stream")
    start_job_fold(arriving, out, stage_path(spark, "job-stream-log")).awaitTermination()
    compact_folds(spark, out)
    return _without_zone(latest_jobs(spark, out, TIMEOUT_SECS))


def _by_day(events: DataFrame) -> list[DataFrame]:
    """The events in order of time, in four parts of two files each."""
    day = F.dayofmonth("ts")
    parts = [events.filter((day > 10 * i) & (day <= 10 * i + 10)).repartition(2) for i in range(3)]
    return [*parts, events.filter(day > 30).repartition(2)]


def _timed_jobs(spark: SparkSession, sf_dir: str, retention_secs: int | None) -> DataFrame:
    out = stage_path(spark, "job-timers")
    arriving = _arriving(spark, _by_day(inp.table(spark, sf_dir, "events")))
    start_job_timers(
        arriving, out, stage_path(spark, "job-timers-log"), TIMEOUT_SECS, retention_secs
    ).awaitTermination()
    return _without_zone(current_jobs(spark, out))


def job_stream_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deadlines that fire on the stream's own clock, for jobs that tell nothing more."""
    return _timed_jobs(spark, sf_dir, None)


def job_stream_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of time; a job is forgotten a day after its end."""
    return _timed_jobs(spark, sf_dir, RETAINED_SECS)


def all_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        f.__name__: f
        for f in (
            intake_requests, inline_decode, root_confinement, size_cap, format_routing,
            option_cleanup, outcome_typing, member_guard, archive_caps, archive_bytes_cap,
            repeated_names, archive_result, archive_assembly, archive_uncut, plain_text, plain_text_html,
            clip_bytes, shared_budget, error_tail, lossy_read, result_record, pick_markdown,
            page_count, page_window, no_output, job_snapshot, job_listing, job_lookup,
            job_deadline, job_cancel, job_retention, job_retention_default,
            document_scan, document_stream, collect_outputs, parse_requests, output_scan, archive_expand, archive_expand_files, archive_expand_sql,
            parse_job_documents, parse_job_supervised, parse_job_archives, archive_ceiling, result_sink, result_sink_committed, doc_stream, job_stream, job_stream_timers, job_stream_retained,
        )
    }
    named.update({k: _text_query(f) for k, f in TEXT_STEPS.items()})
    return named
