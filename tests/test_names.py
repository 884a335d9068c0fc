import base64
import posixpath
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from docloom.functions import names as N
from docloom.functions import payload as P
from docloom.operators import intake as I
from docloom.operators import outcomes as X


def evaluate(spark, values, column, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {type_}")
    got = {r.id: r.out for r in df.select("id", column(F.col("v")).alias("out")).collect()}
    return [got[i] for i in range(len(values))]


NAMES = ["a.tar.gz", ".bashrc", "x.PDF", "noext", "a.", "d/.x.pdf", "..pdf", "a..pdf", "b/c.d/e", "x.y.Z", "é.png"]


def test_suffix_and_stem(spark):
    assert evaluate(spark, NAMES, N.suffix) == [PurePosixPath(n).suffix for n in NAMES]
    assert evaluate(spark, NAMES, N.stem) == [PurePosixPath(n).stem for n in NAMES]


def test_archive_names(spark):
    names = ["a.ZIP", "a.tar.gz", "x/a.tgz", "a.gz", "zip", "a.zip.pdf", ".zip", "a.txz"]
    assert evaluate(spark, names, N.is_archive_name) == [True, True, True, False, False, False, True, True]


def test_fold_path(spark):
    paths = ["/a/b/../c", "/a/./b//c", "/../../x", "/a/b/", "/a", "/a/b/../../../c", "/a..b/.c"]
    assert evaluate(spark, paths, N.fold_path) == [posixpath.normpath(p) for p in paths]


def test_confinement(spark):
    paths = ["/r", "/r/a", "/rx/a", "/r/../outside.pdf", " /r/a ", "", "/q/z"]
    out = evaluate(spark, paths, lambda c: I.confinement_error(c, ["/r", "/q/"]))
    assert [o is None for o in out] == [True, True, False, False, True, False, True]
    assert out[5] == "missing `path`"
    assert all(evaluate(spark, paths[:5], lambda c: I.confinement_error(c, []).isNotNull()))


def test_member_names(spark):
    names = ["a/b.pdf", "./a//b.pdf", "a\\b.pdf", "../x", "a/../b", "/etc/passwd", "\\x", "", ".", "./", "a/..b", ".//", None]
    errors = evaluate(spark, names, N.member_name_error)
    assert [e is None for e in errors] == [True] * 3 + [False] * 7 + [True, True, False]
    assert "leads out" in errors[3] and "root" in errors[5] and "no name" in errors[7]
    assert evaluate(spark, names[:3], N.member_name) == ["a/b.pdf", "a/b.pdf", "a/b.pdf"]


def test_preflight(spark):
    names = ["a.pdf", "a.DOCX", "notes.xyz", "noext", "x.tar.gz", "x.zip"]
    codes = evaluate(spark, names, lambda c: X.preflight(c, office_readable=False)["error_code"])
    assert codes == [None, "missing_dependency", "unsupported_format", "unsupported_format", "unsupported_format", None]
    readable = evaluate(spark, names, lambda c: X.preflight(c)["error_code"])
    assert readable[1] is None
    assert evaluate(spark, ["d/noext"], lambda c: X.preflight(c)["error"]) == ["no reader for `noext`"]


def strict(text):
    try:
        return base64.b64decode(text, validate=True)
    except ValueError:
        return None


def test_inline_payloads(spark):
    texts = ["YWI=", "Y WI=", "YWI", "!!!!", "====", "YQ==", "YQ=", "YWJj", "YWJj\n", "é===", "Y===", "YW=j", "YWJjYQ==YWJj"]
    got = evaluate(spark, texts, P.decode_inline)
    assert [None if g is None else bytes(g) for g in got] == [strict(t) for t in texts]
    sizes = evaluate(spark, texts, P.inline_size)
    assert sizes == [None if strict(t) is None else len(strict(t)) for t in texts]


def test_inline_suffix(spark):
    names = [None, "", "a.PDF", "C:\\d.x\\noext", "x." + "y" * 40, "a\\b.png"]
    assert evaluate(spark, names, P.inline_suffix) == [".pdf", ".pdf", ".PDF", ".pdf", "." + "y" * 15, ".png"]


def test_requests(spark):
    big = base64.b64encode(b"x" * 50).decode()
    rows = [("/r/a.pdf", None), (None, "YWI="), ("/r/a.pdf", "YWI="), (None, None), ("", ""), ("/x/a.pdf", None), (None, big), (None, "Y WI")]
    df = spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(rows)], "request_id int, path string, content_base64 string")
    got = {r.request_id: r for r in I.check_requests(df, ["/r"], 49).collect()}
    assert [got[i].accepted for i in range(8)] == [True, True] + [False] * 6
    assert [got[i].error_code for i in range(2, 8)] == [None] * 3 + ["input_rejected"] * 3
    assert "50 bytes, over the 49-byte limit" in got[6].error
