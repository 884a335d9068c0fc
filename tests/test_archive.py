import io
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom.operators import archive as A
from docloom.sources.containers import (
    TooLarge, _bounded, _failed, expand_archives, expand_files, register_expand_archive,
)
from docloom.sources import tree

MEMBER = "archive string, ordinal bigint, name string, markdown string, page_count bigint, error_code string, error string"
ENTRY = "archive string, container string, ordinal bigint, name string, kind string, declared_size bigint"


def zipped(*entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for e in entries:
            name, data, mode = (*e, 0o100644)[:3]
            info = zipfile.ZipInfo(name)
            info.external_attr = mode << 16
            z.writestr(info, data)
    return out.getvalue()


def tarred(*entries, mode="w:xz"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for e in entries:
            name, data, kind = (*e, tarfile.REGTYPE)[:3]
            info = tarfile.TarInfo(name)
            info.type, info.size, info.linkname = kind, len(data), "x" if kind in (tarfile.SYMTYPE, tarfile.LNKTYPE) else ""
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def expand(spark, blobs, **caps):
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in blobs.items()], "path string, content binary")
    return expand_archives(df, **caps)


def verdicts(spark, blobs, max_members=512, max_bytes=1 << 29):
    entries = expand(spark, blobs, max_members=max_members, max_bytes=max_bytes)
    return {r.archive: r for r in A.archive_verdicts(entries, max_members, max_bytes).collect()}


def test_expand_keeps_order_and_bytes(spark):
    blobs = {
        "/a.zip": zipped(("d/", b""), ("d/x.pdf", b"one"), ("y.pdf", b"two")),
        "/b.tar.xz": tarred(("d", b"", tarfile.DIRTYPE), ("d/x.pdf", b"one"), ("y.pdf", b"two")),
        "/c.tgz": tarred(("y.pdf", b"two"), mode="w:gz"),
        "/d.zip": b"not an archive",
        "/e.zip": tarred(("y.pdf", b"z"), mode="w:bz2"),
    }
    rows = expand(spark, blobs).orderBy("archive", "ordinal").collect()
    got = [(r.archive, r.container, r.kind, r.name.rstrip("/"), bytes(r.content or b"")) for r in rows]
    assert got == [
        ("/a.zip", "zip", "dir", "d", b""), ("/a.zip", "zip", "file", "d/x.pdf", b"one"), ("/a.zip", "zip", "file", "y.pdf", b"two"),
        ("/b.tar.xz", "tar", "dir", "d", b""), ("/b.tar.xz", "tar", "file", "d/x.pdf", b"one"), ("/b.tar.xz", "tar", "file", "y.pdf", b"two"),
        ("/c.tgz", "tar", "file", "y.pdf", b"two"),
        ("/d.zip", "none", "unreadable", "", b""),
        ("/e.zip", "tar", "file", "y.pdf", b"z"),
    ]
    assert rows[7].error == "`d.zip` opens neither as zip nor as tar"


def test_files_expand_like_contents(spark, tmp_path):
    """Members read by themselves give what whole archives give, broken ones included."""
    good = zipped(("d/", b""), ("d/x.pdf", b"one"), ("y.pdf", b"two" * 5000), ("y.pdf", b"again"), ("l", b"a", 0o120777))
    broken = bytearray(good)
    broken[good.index(b"twotwo") + 7] ^= 1  # a checksum that fails
    blobs = {
        "a.zip": good, "_b.zip": bytes(broken), "c.zip": good[: len(good) // 2], "d.zip": b"no archive", "e.zip": b"",
        "f.zip": zipped(), "g.zip": zipped(*[(f"{i}.pdf", str(i).encode()) for i in range(12)]),
        "h.zip": zipped(*[(f"{i}.pdf", b"x" * 90) for i in range(9)]), "i.zip": zipped(("big.pdf", b"0" * 900)),
        **{f"t{n}.tar": tarred(("d", b"", tarfile.DIRTYPE), ("d/x.pdf", b"one"), ("y", b"", tarfile.SYMTYPE), mode=m) for n, m in enumerate(("w", "w:gz", "w:bz2", "w:xz"))},
        "u.tgz": tarred(*[(f"{i}.pdf", random.Random(i).randbytes(300)) for i in range(30)], mode="w:gz")[:4000],
        "v.tar": tarred(*[(f"{i}.pdf", b"x") for i in range(12)], mode="w"),
    }
    rows = [(name, bytearray(data)) for name, data in blobs.items()]
    tree.write_tree(spark.createDataFrame(rows, "file string, content binary"), str(tmp_path / "in"))
    listing = tree.list_tree(spark, str(tmp_path / "in"))
    for caps in ({"max_members": 10, "max_bytes": 800}, {"max_members": 100, "max_bytes": 1 << 20}):
        whole = {(r.archive, r.ordinal): tuple(r)[1:] for r in expand(spark, blobs, **caps).collect()}
        found = expand_files(listing, **caps)
        got = [(r.archive.rsplit("/", 1)[1], r.ordinal, tuple(r)[1:]) for r in found.collect()]
        assert len(got) == len(whole) and {(a, n): r for a, n, r in got} == whole


def test_members_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    data = zipped(*[(f"{i:03}.pdf", random.Random(i).randbytes(20_000)) for i in range(200)])
    (tmp_path / "one.zip").write_bytes(data)
    found = expand_files(tree.list_tree(spark, str(tmp_path)))
    held = found.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("content")).alias("n")).collect()
    assert len(held) >= 4 and max(r.n for r in held) < len(data) // 2 and sum(r.n for r in held) == 200 * 20_000


def test_verdicts(spark):
    ok = ("a.pdf", b"x")
    blobs = {
        "ok": zipped(ok), "up": zipped(ok, ("../escaped.txt", b"p")), "abs": zipped(("/etc/passwd", b"p")),
        "link": zipped(ok, ("l", b"a", 0o120777)), "sym": tarred(("l", b"", tarfile.SYMTYPE)),
        "hard": tarred(ok, ("l", b"", tarfile.LNKTYPE)), "fifo": tarred(("p", b"", tarfile.FIFOTYPE)),
        "many": zipped(*[(f"{i}.pdf", b"") for i in range(6)]), "tmany": tarred(*[(f"{i}.pdf", b"") for i in range(9)]),
        "big": zipped(("a.pdf", b"x" * 60), ("b.pdf", b"x" * 60)), "fits": tarred(("a.pdf", b"x" * 60), ("b.pdf", b"x" * 40)),
        "bigbad": tarred(("a.pdf", b"x" * 101), ("../b", b"")), "badbig": tarred(("../b", b""), ("a.pdf", b"x" * 101)),
        "dirs": zipped(("d/", b""), ("e/", b"")), "empty": zipped(), "junk": b"junk", "cut": tarred(("a.pdf", b"x" * 90), mode="w:")[:560],
    }
    got = verdicts(spark, blobs, max_members=5, max_bytes=100)
    said = {k: (got[k].error_code, got[k].error) if k in got else None for k in blobs}
    rejected = "input_rejected"
    assert said["ok"] == said["fits"] == said["dirs"] == (None, None)
    assert said["up"] == (rejected, "entry `../escaped.txt` leads out of its folder")
    assert said["abs"] == (rejected, "entry `/etc/passwd` starts at the root")
    assert said["link"] == (rejected, "entry `l` is a symbolic link")
    assert said["sym"] == said["hard"] == (rejected, "entry `l` is a link to elsewhere")
    assert said["fifo"] == (rejected, "entry `p` is no ordinary file")
    assert said["many"] == (rejected, "archive lists 6 entries, over the 5 limit")
    assert said["tmany"] == (rejected, "archive lists more than 5 members")
    assert said["big"] == said["bigbad"] == (rejected, "archive unpacks beyond the 100-byte limit")
    assert "leads out" in said["badbig"][1]
    assert said["junk"][0] == rejected and "opens neither" in said["junk"][1]
    assert said["cut"][0] == "parse_failed"
    assert said["empty"] == (None, None) and got["empty"].n_entries == 0
    assert got["dirs"].n_files == 0 and got["dirs"].n_entries == 2


def test_corrupt_member_fails_its_archive(spark):
    blob = bytearray(zipped(("a.pdf", b"hello hello"), ("b.pdf", b"fine")))
    at = blob.index(b"hello")
    blob[at] ^= 1
    got = verdicts(spark, {"bad": bytes(blob)})["bad"]
    assert got.error_code == "parse_failed" and got.error.startswith("BadZipFile")


def test_last_copy_wins(spark):
    rows = [("a", 0, "x", "1"), ("a", 1, "y", "2"), ("a", 2, "x", "3"), ("b", 0, "x", "4")]
    df = spark.createDataFrame(rows, "archive string, ordinal bigint, name string, content string")
    got = sorted((r.archive, r.ordinal, r.content) for r in A.last_copies(df).collect())
    assert got == [("a", 0, "3"), ("a", 1, "2"), ("a", 2, "3"), ("b", 0, "4")]


def loop(members, budget):
    """The rule as a loop over one archive's members."""
    ordered = sorted(members, key=lambda m: (m[1].split("/"), m[0]))
    sections, warnings, sources, pages, used, over, late = [], [], [], 0, 0, False, False
    for at, (_, name, markdown, count, code, error) in enumerate(ordered):
        if code == "timeout":
            late = True
            break
        if code:
            warnings.append(f"{name}: {error}")
        elif not (markdown or "").strip():
            warnings.append(f"{name}: parsed to an empty document")
        else:
            section = f"# {name}\n\n{markdown.strip()}"
            if used + len(section.encode()) + 2 > budget:
                warnings.append(f"no room for more: {len(ordered) - at} of {len(ordered)} entries are left out")
                over = True
                break
            used += len(section.encode()) + 2
            sections.append(section)
            sources.append(name)
            pages += count or 0
    return "\n\n".join(sections), warnings, sources, pages or None, over, late


def test_assembly_matches_loop(spark):
    rng = random.Random(1)
    archives = {}
    for a in range(150):
        members = []
        for o in range(rng.randint(1, 14)):
            name = rng.choice(["x/", "x-", "x/y/", "é", ""]) + str(rng.randint(0, 8))
            roll = rng.random()
            code = "timeout" if roll < 0.02 else "parse_failed" if roll < 0.2 else None
            text = rng.choice(["", " 　\n", "word " * rng.randint(1, 9), " é€ \n" * rng.randint(1, 5)])
            members.append((o, name, text, rng.choice([None, 0, 3]), code, code and "bad"))
        archives[f"a{a}"] = members
    rows = [(a, *m) for a, ms in archives.items() for m in ms]
    df = spark.createDataFrame(rows, MEMBER)
    for budget in (0, 60, 150, 10_000):
        got = {r.archive: r for r in A.assemble_archives(df, budget, 512).collect()}
        assert len(got) == len(archives)
        for a, members in archives.items():
            markdown, warnings, sources, pages, over, late = loop(members, budget)
            r = got[a]
            assert (r.error_code == "timeout") == late, a
            if not late:
                assert (r.markdown, r.warnings, r.sources, r.page_count, r.over_budget) == (markdown, warnings, sources, pages, over), a


@pytest.mark.parametrize("size, code", [(5, None), (6, "input_rejected"), (400, "input_rejected")])
def test_assembly_refuses_too_many_members(spark, size, code):
    df = spark.createDataFrame([("a", i, f"{i}.pdf", "x", None, None, None) for i in range(size)], MEMBER)
    rows = A.assemble_archives(df, 1000, 5).collect()
    assert [r.error_code for r in rows] == [code]


def test_table_function(spark):
    register_expand_archive(spark)
    df = spark.createDataFrame([("/t.zip", bytearray(zipped(("a.pdf", b"x"))))], "path string, content binary")
    rows = spark.sql("SELECT e.name, e.content FROM {df} f, LATERAL expand_archive(f.path, f.content) e", df=df).collect()
    assert [(r.name, bytes(r.content)) for r in rows] == [("a.pdf", b"x")]
    capped = spark.sql("SELECT e.content FROM {df} f, LATERAL expand_archive(f.path, f.content, 5, 0) e", df=df)
    assert [r.content for r in capped.collect()] == [None]


def test_a_member_over_the_ceiling_is_refused():
    assert _bounded(io.BytesIO(b"x" * 10), 10) == b"x" * 10
    with pytest.raises(TooLarge) as caught:
        _bounded(io.BytesIO(b"x" * 11), 10)
    assert _failed(caught.value)[0] == "input_rejected"


def test_members_share_one_time_budget(spark):
    rows = [("a", i, f"{i}.pdf", "x", None, None, None, 40) for i in range(3)]
    rows += [("b", i, f"{i}.pdf", "x", None, None, None, 40) for i in range(2)]
    df = spark.createDataFrame(rows, f"{MEMBER}, elapsed_ms bigint")
    got = {r.archive: r.error_code for r in A.assemble_archives(df, 1000, 5, timeout_ms=100).collect()}
    assert got == {"a": "timeout", "b": None}
