import base64
import os

from pyspark.sql import functions as F

from docloom.limits import Limits
from docloom.operators.hook import ParseFailure, decode_text
from docloom.plans.parse_job import (
    Host, parse_archives, parse_folder, parse_inline, parse_requests, parse_single,
)
from docloom.sources import files, sinks
from test_archive import tarred, zipped


def make_parser():
    """A closure, so that it travels to the workers by value."""

    def parser(name, content, options):
        text = content.decode()
        if text == "slow":
            raise TimeoutError
        if text == "bad":
            raise ParseFailure("parse_failed", f"cannot read {name}")
        if text == "crash":
            raise ValueError("oops")
        return f"# {options.get('lang', 'none')}\n\n{text}", 2

    return parser


def folder(tmp_path):
    made = {
        "a.pdf": b"alpha", "sub/b.PNG": b"beta", "bad.pdf": b"bad", "crash.pdf": b"crash", "slow.pdf": b"slow",
        "notes.xyz": b"?", "w.docx": b"office", "long.pdf": b"x" * 5000, "blank.zip": zipped(("d/", b"")), "void.zip": zipped(),
        "ok.zip": zipped(("b/2.pdf", b"two"), ("a.pdf", b"old"), ("a.pdf", b"new"), ("c.xyz", b"?"), ("inner.tar.gz", b"?")),
        "evil.tar": tarred(("../x", b"1"), mode="w:"), "late.zip": zipped(("1.pdf", b"ok"), ("2.pdf", b"slow")),
        "fake.zip": b"nope",
    }
    for name, data in made.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(data)
    return str(tmp_path)


def test_parse_folder(spark, tmp_path):
    root = folder(tmp_path)
    limits = Limits(max_input_bytes=4000)
    out = parse_folder(spark, root, limits, make_parser(), office_readable=False, options='{"lang": "en"}')
    rows = {os.path.relpath(r.path.removeprefix("file:"), root): r for r in out.collect()}
    codes = {k: r.error_code for k, r in rows.items()}
    assert codes == {
        "a.pdf": None, "sub/b.PNG": None, "bad.pdf": "parse_failed", "crash.pdf": "parse_failed", "slow.pdf": "timeout",
        "notes.xyz": "unsupported_format", "w.docx": "missing_dependency", "long.pdf": "input_rejected", "blank.zip": "parse_failed", "void.zip": "parse_failed",
        "ok.zip": None, "evil.tar": "input_rejected", "late.zip": "timeout", "fake.zip": "input_rejected",
    }
    assert rows["a.pdf"].result.markdown == "# en\n\nalpha" and rows["a.pdf"].result.metadata.page_count == 2
    assert rows["w.docx"].missing_dependencies == ["libreoffice"]
    assert rows["crash.pdf"].error == "ValueError: oops"
    joined = rows["ok.zip"].result
    section = "# a.pdf\n\n# en\n\nnew"
    assert joined.markdown == f"{section}\n\n{section}\n\n# b/2.pdf\n\n# en\n\ntwo"
    assert joined.metadata.sources == ["a.pdf", "a.pdf", "b/2.pdf"] and joined.metadata.page_count == 6
    assert joined.warnings == ["c.xyz: no reader for `.xyz`", "inner.tar.gz: no reader for `.gz`"]


def test_inline_requests(spark):
    def encoded(data):
        return base64.b64encode(data).decode()

    rows = [
        (1, None, encoded(b"one"), "x.PDF"), (2, "/a.pdf", None, None), (3, None, "not base64", None),
        (4, None, encoded(zipped(("a.pdf", b"in zip"))), "C:\\dir\\up.zip"), (5, None, encoded(b"five"), None),
    ]
    df = spark.createDataFrame(rows, "request_id int, path string, content_base64 string, filename string")
    options = '{"backend": "hybrid-engine", "lang": " EN ", "effort": "wild", "hint": 1}'
    seen = {r.path: r.result for r in parse_inline(df, Limits(), make_parser(), options=options).collect()}
    assert {k: v.markdown for k, v in seen.items()} == {
        "inline/1.PDF": "# en\n\none", "inline/4.zip": "# a.pdf\n\n# en\n\nin zip", "inline/5.pdf": "# en\n\nfive",
    }
    assert {v.metadata.parse_backend for v in seen.values()} == {"hybrid-engine"}


def test_files_with_odd_names_are_refused_by_sparks_source(spark, tmp_path):
    for name in ("a.pdf", "_b.pdf", ".c.pdf", "_d/e.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = parse_folder(spark, str(tmp_path), in_tasks=False).collect()
    rows = {os.path.relpath(r.path.removeprefix("file:"), tmp_path): r.error_code for r in found}
    assert rows == {"a.pdf": None, "_b.pdf": "input_rejected", ".c.pdf": "input_rejected", "_d/e.pdf": "input_rejected"}


def test_options_by_row_and_host_defaults(spark):
    rows = [
        ("/a.pdf", bytearray(b"a"), '{"backend": "vlm-engine"}'), ("/b.pdf", bytearray(b"b"), None),
        ("/c.pdf", bytearray(b"c"), "not json"),
        ("/z.zip", bytearray(zipped(("m.pdf", b"m"))), '{"backend": "hybrid-engine", "lang": "de"}'),
    ]
    df = spark.createDataFrame(rows, "path string, content binary, options string")
    host = Host(backend="vlm-http-client", lang="fr")
    singles = parse_single(df.where("path != '/z.zip'"), Limits(), make_parser(), options='{"lang": "en"}', host=host)
    got = {r.path: (r.result.markdown[:4], r.result.metadata.parse_backend) for r in singles.collect()}
    assert got == {"/a.pdf": ("# fr", "vlm-engine"), "/b.pdf": ("# en", "vlm-http-client"), "/c.pdf": ("# fr", "vlm-http-client")}
    packed = parse_archives(df.where("path = '/z.zip'"), Limits(), make_parser(), host=host).first()
    assert packed.result.metadata.parse_backend == "hybrid-engine" and "# de" in packed.result.markdown


def test_requests_end_to_end(spark):
    listing = spark.createDataFrame(
        [("/in/a.pdf", 5, bytearray(b"alpha")), ("/in/big.pdf", 99, bytearray(b"x")), ("/in/z.zip", 9, bytearray(zipped(("m.pdf", b"m"))))],
        "path string, length bigint, content binary",
    )
    rows = [
        (1, "/in/a.pdf", None, None, None), (2, "/in/x/../a.pdf", None, None, '{"lang": "de"}'), (3, "/in/none.pdf", None, None, None),
        (4, "/etc/a.pdf", None, None, None), (5, "/in/z.zip", None, None, None), (6, None, None, None, None),
        (7, None, base64.b64encode(b"seven").decode(), "s.pdf", None), (8, None, "?", None, None), (9, "/in/big.pdf", None, None, None),
    ]
    df = spark.createDataFrame(rows, "request_id bigint, path string, content_base64 string, filename string, options string")
    out = parse_requests(df, listing, ["/in"], Limits(max_input_bytes=50), make_parser())
    got = {r.request_id: (r.error_code, r.result.markdown if r.result else r.error) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        1: None, 2: None, 3: "input_rejected", 4: "input_rejected", 5: None, 6: None, 7: None, 8: "input_rejected", 9: "input_rejected",
    }
    assert got[1][1] == "# none\n\nalpha" and got[2][1] == "# de\n\nalpha" and got[7][1] == "# none\n\nseven"
    assert got[3][1] == "cannot open `/in/none.pdf`" and "not both" in got[6][1] and got[5][1].startswith("# m.pdf")


def test_a_late_document_is_a_timeout(spark):
    def sleepy(name, content, options):
        import time

        time.sleep(float(content))
        return "done", 1

    df = spark.createDataFrame([("/a.pdf", bytearray(b"1.5")), ("/b.pdf", bytearray(b"0"))], "path string, content binary")
    got = {r.path: r.error_code for r in parse_single(df, Limits(timeout_secs=1), sleepy).collect()}
    assert got == {"/a.pdf": "timeout", "/b.pdf": None}


def test_long_output_is_clipped(spark):
    docs = spark.createDataFrame([("/r/a.pdf", bytearray("é".encode() * 500))], "path string, content binary")
    row = parse_single(docs, Limits(max_output_bytes=101, min_text_bytes=1), decode_text).first()
    assert row.result.markdown == "é" * 50 and row.result.truncated


def test_sink_and_listing(spark, tmp_path):
    rows = [("a", None, None, "payload"), ("b", "timeout", "late", None)]
    df = spark.createDataFrame(rows, "path string, error_code string, error string, result string")
    target = str(tmp_path / "results")
    sinks.write_results(sinks.with_status(df), target)
    listing = sinks.read_listing(spark, target)
    assert "result" not in listing.columns
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "result" not in plan.split("ReadSchema")[1]
    done = sinks.read_results(spark, target).where("status = 'succeeded'")
    assert [r.result for r in done.collect()] == ["payload"]


def test_scans(spark, tmp_path):
    root = folder(tmp_path)
    plan = files.scan_documents(spark, root, 100)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,100)" in plan
    assert "content" not in files.list_documents(spark, root)._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    names = {os.path.basename(r.path) for r in files.scan_archives(spark, root, 10**6).select("path").collect()}
    assert names == {"blank.zip", "void.zip", "ok.zip", "evil.tar", "late.zip", "fake.zip"}
    (tmp_path / "p1" / "auto").mkdir(parents=True)
    (tmp_path / "p1" / "auto" / "doc.md").write_text("hi")
    outputs = files.scan_outputs(spark, root, "*.md").collect()
    assert [(r.parse_id, r.file, r.size) for r in outputs] == [("p1", "p1/auto/doc.md", 2)]
