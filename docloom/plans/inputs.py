"""Inputs of the registered queries, derived row by row from the given tables.

Archives are cut from ``documents`` by source and block of a thousand ids, so
their number grows with the table and no archive does, whatever the skew.
"""

from __future__ import annotations

import io
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EXTENSIONS = (".pdf", ".PDF", ".docx", ".png", ".tiff", ".xlsx", ".doc", ".xyz", ".zip", ".tar.gz")
ARCHIVE_BLOCK = 1000
PACKED_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int") + 1)


def file_name() -> Column:
    return F.concat("lang", F.lit("/d"), F.col("doc_id").cast("string"), _pick(EXTENSIONS, F.col("doc_id")))


def markdown() -> Column:
    """Raw texts carry no markup, so each gets one piece of every kind."""
    doc = F.col("doc_id").cast("string")
    return F.concat(
        F.lit("# "), F.col("source"), F.lit("\n\n> "), F.col("lang"),
        F.lit("\n\n- **"), doc, F.lit("** [src](http://x/"), doc,
        F.lit(") ![pic"), doc, F.lit("](y)\n\n```py\nx_1 = `a`\n```\n\n<table><tr><td>"),
        F.col("n_chars").cast("string"), F.lit("</td></tr></table>  \r\n\n\n\n"), F.col("text"),
    )


def markdown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("markdown", markdown())


def entries(
    spark: SparkSession, sf_dir: str, with_text: bool = True, tasks: int | None = None
) -> DataFrame:
    """Archive entries with their text as content; some names and kinds are bad.

    ``tasks``: how many share the archives, if Spark is not to decide.
    """
    docs = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    block = F.floor(doc / ARCHIVE_BLOCK).cast("string")
    in_order = Window.partitionBy("archive").orderBy("doc_id")
    name = (
        F.when(doc % 397 == 5, F.concat(F.lit("../"), file_name()))
        .when(doc % 401 == 7, F.concat(F.lit("/"), file_name()))
        .when(doc % 53 == 3, F.concat(F.lit("./"), F.replace(file_name(), F.lit("/"), F.lit("//"))))
        .otherwise(file_name())
    )
    docs = docs.withColumn("archive", F.concat("source", F.lit("-"), block))
    if tasks is not None:
        docs = docs.repartition(tasks, "archive")
    return (
        docs.withColumn("container", F.when(F.floor(doc / ARCHIVE_BLOCK) % 2 == 0, "zip").otherwise("tar"))
        .withColumn("kind", F.when(doc % 499 == 11, "symlink").when(doc % 83 == 1, "dir").otherwise("file"))
        .withColumn("declared_size", F.octet_length("text").cast("bigint"))
        .withColumn("name", name)
        .drop(*(() if with_text else ("text",)))  # before the window, so it is not sorted
        .withColumn("ordinal", F.row_number().over(in_order).cast("bigint") - 1)
    )


def parsed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members after parsing: routed by format, some blank, a few timed out.

    The place within the block serves as ordinal, so no window is needed for it.
    """
    from docloom.operators.outcomes import TIMEOUT, preflight

    doc = F.col("doc_id")
    block = F.floor(doc / ARCHIVE_BLOCK).cast("string")
    failure = preflight(F.col("name"), office_readable=False)
    late = F.col("failure").isNull() & (doc % 331 == 8)
    return (
        table(spark, sf_dir, "documents")
        .withColumn("markdown", markdown())
        .withColumn("archive", F.concat("source", F.lit("-"), block))
        .withColumn("ordinal", doc % ARCHIVE_BLOCK)
        .withColumn("name", file_name())
        .withColumn("failure", failure)
        .select(
            "archive", "ordinal", "name",
            F.when(doc % 41 == 0, F.lit(" \n\u3000\t")).otherwise(F.col("markdown")).alias("markdown"),
            F.when(doc % 4 != 0, doc % 4).alias("page_count"),
            F.when(late, F.lit(TIMEOUT)).otherwise(F.col("failure.error_code")).alias("error_code"),
            F.when(late, F.lit("the parse exceeded its time budget"))
            .otherwise(F.col("failure.error")).alias("error"),
        )
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    by_path = (doc % 2 == 1) | (doc % 50 == 0)
    by_content = (doc % 2 == 0) & (doc % 77 != 0)
    tail = doc.cast("string")
    path = (
        F.when(doc % 15 == 3, F.concat(F.lit("/data/src1/.././"), F.col("source"), F.lit("/"), tail))
        .when(doc % 15 == 7, F.concat(F.lit("/data/"), F.col("source"), F.lit("/../../etc/"), tail))
        .otherwise(F.concat(F.lit("/data/"), F.col("source"), F.lit("/"), tail))
    )
    encoded = F.replace(F.base64(F.col("text").cast("binary")), F.lit("\r\n"), F.lit(""))
    content = (
        F.when(doc % 38 == 0, F.concat(F.left(encoded, F.lit(5)), F.lit(" "), F.substring(encoded, 6, 1 << 30)))
        .when(doc % 46 == 0, F.rtrim(encoded, F.lit("=")))
        .otherwise(encoded)
    )
    filename = F.when(doc % 6 == 0, F.concat(F.lit("C:\\in.dir\\"), file_name())).when(
        doc % 6 == 2, F.lit("noext")
    ).when(doc % 6 == 4, file_name())
    return table(spark, sf_dir, "documents").select(
        doc.alias("request_id"),
        F.when(by_path & (doc % 77 != 0), path).alias("path"),
        F.when(by_content, content).alias("content_base64"),
        filename.alias("filename"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


# Option texts that mix valid, invalid, wrongly typed and unknown settings.
OPTION_TEXTS = (
    '{"backend": " Pipeline ", "method": "OCR", "lang": "en", "start_page": 0, "end_page": 3}',
    '{"backend": "vlm-engine", "method": "txt", "effort": "high", "formula": false}',
    '{"backend": "hybrid-engine", "method": "auto", "effort": " High", "table": "false"}',
    '{"backend": 7, "method": "best", "effort": "high", "lang": "E1", "formula": 0}',
    '{"backend": "unknown", "device": "cuda:1", "start_page": true, "end_page": -1}',
    '{"device": "CPU", "lang": "", "table": "", "start_page": 2.5, "end_page": "4"}',
    '{"device": "cuda:100", "lang": "ch_server", "table": [], "formula": {}, "hint": 1}',
    '{"backend": null, "formula": null, "table": {"a": 1}, "start_page": 12, "end_page": 1}',
    '{"method": ["ocr"], "formula": [0], "table": 0.5, "lang": 5}',
    "{}",
    '{"backend": "hybrid-http-client", "effort": "medium", "device": "mps", "formula": "x"}',
)


def option_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event, F.parse_json(_pick(OPTION_TEXTS, event)).alias("options")
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output files of parses of four documents; some parses wrote no markdown."""
    doc = F.col("doc_id")
    parse = F.floor(doc / 4).cast("bigint")
    written = F.when(parse % 9 == 4, ".json").otherwise(".md")
    return table(spark, sf_dir, "documents").select(
        parse.alias("parse_id"),
        F.concat(F.lit("out/"), F.col("lang"), F.lit("/d"), doc.cast("string"), written).alias("file"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.when(parse % 3 == 0, F.concat(F.lit("D"), (parse * 4 + 1).cast("string")))
        .otherwise("none").alias("wanted"),
    )


def parses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parses behind ``candidates``; the first document's text is the log."""
    parse = F.floor(F.col("doc_id") / 4).cast("bigint")
    firsts = table(spark, sf_dir, "documents").groupBy(parse.alias("parse_id")).agg(
        F.min_by("text", "doc_id").alias("log")
    )
    return firsts.select(
        "parse_id",
        F.concat(F.lit("d"), F.col("parse_id").cast("string"), F.lit(".pdf")).alias("filename"),
        F.col("log").cast("binary").alias("log"),
    )


def content_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One content list per event, three to a parse, of mixed item types."""
    event = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    shape = event % 5
    body = (
        F.when(shape == 0, F.concat(F.lit('[{"page_idx": '), k, F.lit('}, {"page_idx": "900"}, 5, {"page_idx": true}]')))
        .when(shape == 1, F.concat(F.lit('[{"page_idx": "'), k, F.lit('"}, {"page_idx": 2.5}, {"page_idx": null}, []]')))
        .when(shape == 2, F.concat(F.lit('{"page_idx": '), k, F.lit("}")))
        .when(shape == 3, F.concat(F.lit('[{"page_idx": '), k, F.lit("}, {")))
        .when(event % 3 == 0, F.concat(F.lit('[{"page_idx": 0, "score": NaN}, {"page_idx": 1, "page_idx": '), k, F.lit("}]")))
        .otherwise(F.concat(F.lit('[{"type": "text", "page_idx": 0}, {"page_idx": '), k, F.lit("}]")))
    )
    lists = table(spark, sf_dir, "events").select(
        F.floor(event / 3).cast("bigint").alias("parse_id"),
        F.concat(F.lit("p"), event.cast("string"), F.lit("_content_list.json")).alias("file"),
        body.alias("json"),
    )
    return lists.withColumn("size", F.octet_length("json").cast("bigint"))


def as_job_events(events: DataFrame, *more: str) -> DataFrame:
    """Works on the table and on a stream of it alike."""
    status = (
        F.when(F.col("event_type") == "view", "queued")
        .when(F.col("event_type") == "click", "running")
        .when(F.col("event_type") == "purchase", "succeeded")
        .when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "cancelled")
    )
    return events.select(
        (F.col("user_id") * 31 + F.dayofmonth("ts")).alias("job_id"),
        "ts",
        F.col("event_id").alias("seq"),
        status.alias("status"),
        *more,
    )


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_job_events(table(spark, sf_dir, "events"))


def told_job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with what its events tell: the file, the error, the result."""
    events = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    failed, done = F.col("event_type") == "error", F.col("event_type") == "purchase"
    told = {
        "filename": F.when(F.col("event_type") != "click", F.concat(F.lit("d"), number, F.lit(".pdf"))),
        "error_code": F.when(failed, F.when(F.col("event_id") % 3 == 0, "missing_dependency").otherwise("parse_failed")),
        "error": F.when(failed, F.concat(F.lit("failed at "), number)),
        "missing_dependencies": F.when(failed & (F.col("event_id") % 3 == 0), F.array(F.lit("libreoffice"))),
        "result": F.when(done, F.concat(F.lit("result of "), number)),
    }
    return as_job_events(events.withColumns(told), *told)


def packed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entries`` packed into real zip and tar files, one row per archive.

    An archive holds at most a thousand documents, so no group can outgrow a task; and the
    tasks grow with the bytes, so none gets many archives and hands them on at once.
    """
    size = table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // PACKED_BYTES))
    rows = entries(spark, sf_dir, tasks=tasks).select(
        "archive", "container", "ordinal", "name", "kind", F.col("text").cast("binary").alias("content")
    )
    return rows.groupBy("archive", "container").applyInPandas(_pack, "path string, content binary")


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("ordinal")
    container = rows["container"].iloc[0]
    out = io.BytesIO()
    if container == "zip":
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
            for name, kind, content in zip(rows["name"], rows["kind"], rows["content"]):
                info = zipfile.ZipInfo(name + "/" if kind == "dir" else name)
                info.external_attr = (0o120777 if kind == "symlink" else 0o100644) << 16
                target.writestr(info, b"" if kind == "dir" else content)
    else:
        with tarfile.open(fileobj=out, mode="w:gz") as target:
            for name, kind, content in zip(rows["name"], rows["kind"], rows["content"]):
                info = tarfile.TarInfo(name)
                info.type = {"dir": tarfile.DIRTYPE, "symlink": tarfile.SYMTYPE}.get(kind, tarfile.REGTYPE)
                info.size = len(content) if kind == "file" else 0
                target.addfile(info, io.BytesIO(content) if kind == "file" else None)
    suffix = ".zip" if container == "zip" else ".tar.gz"
    path = f"/data/{rows['archive'].iloc[0]}{suffix}"
    return pd.DataFrame({"path": [path], "content": [out.getvalue()]})


def job_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd documents asked for by path, even ones sent along; some ask for neither."""
    doc = F.col("doc_id")
    given = doc % 77 != 0
    backend = _pick(("pipeline", "vlm-engine", "hybrid-engine"), doc)
    encoded = F.replace(F.base64(F.col("text").cast("binary")), F.lit("\r\n"), F.lit(""))
    return table(spark, sf_dir, "documents").select(
        doc.alias("request_id"),
        F.when(given & (doc % 2 == 1), listed_path(doc % 9 == 4)).alias("path"),
        F.when(given & (doc % 2 == 0), encoded).alias("content_base64"),
        file_name().alias("filename"),
        F.concat(F.lit('{"backend": "'), backend, F.lit('"}')).alias("options"),
    )


def listed_path(outside: Column) -> Column:
    root = F.when(outside, F.lit("/etc/")).otherwise(F.lit("/data/"))
    return F.concat(root, F.col("source"), F.lit("/"), file_name())


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scan of the roots finds: most of the files asked for."""
    docs = table(spark, sf_dir, "documents").where(F.col("doc_id") % 7 != 3)
    content = F.col("text").cast("binary")
    return docs.select(
        listed_path(F.lit(False)).alias("path"),
        F.octet_length(content).cast("bigint").alias("length"),
        content.alias("content"),
    )


def output_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What parsers wrote: texts of documents and content lists of events."""
    doc = F.col("doc_id")
    parse = F.floor(doc / 4).cast("bigint")
    written = F.when(parse % 9 == 4, ".json").otherwise(".md")
    texts = table(spark, sf_dir, "documents").select(
        parse.alias("parse_id"),
        F.concat(F.lit("out/"), F.col("lang"), F.lit("/d"), doc.cast("string"), written).alias("file"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.col("text").cast("binary").alias("content"),
    )
    lists = content_lists(spark, sf_dir).select(
        "parse_id", "file", "size", F.col("json").cast("binary").alias("content")
    )
    return texts.unionByName(lists)
