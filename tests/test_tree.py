"""Trees listed and read by tasks: names of every kind, links, sizes, repeated writes."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from docloom.limits import Limits
from docloom.operators import intake as I
from docloom.plans.parse_job import parse_folder
from docloom.sources import tree


def put(root, name, data=b"x"):
    target = root / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(data)


def test_list_and_read_equal_a_walk(spark, tmp_path):
    r = random.Random(3)
    for _ in range(300):
        folders = [r.choice(["a", "_b", ".c", "d e", "é", "f%20g", "h=1", "_temporary"]) for _ in range(r.randint(0, 5))]
        put(tmp_path, "/".join([*folders, r.choice("_. xyz").strip() + f"n{r.randrange(99)}" + r.choice(["", ".md", ".pdf"])]), r.randbytes(r.randrange(300)))
    put(tmp_path, "_SUCCESS", b"")
    put(tmp_path, ".lone.crc", b"own")
    put(tmp_path, ".zz.md.crc", b"checksum")
    put(tmp_path, "zz.md", b"")
    want = {}
    for folder, _, names in os.walk(tmp_path):
        for name in names:
            path = os.path.join(folder, name)
            with open(path, "rb") as f:
                want[f"file:{path}"] = f.read()
    del want[f"file:{tmp_path}/.zz.md.crc"]
    listing = tree.list_tree(spark, str(tmp_path))
    assert {x.path: x.length for x in listing.collect()} == {k: len(v) for k, v in want.items()}
    got = tree.read_tree(listing.select("path", "length", F.lit(1).alias("content_no"))).collect()
    assert {x.path: bytes(x.content) for x in got} == want and len(got) == len(want)


def test_empty_missing_and_flat_trees(spark, tmp_path, monkeypatch):
    (tmp_path / "none" / "_empty").mkdir(parents=True)
    for root in ("none", "missing"):
        listing = tree.list_tree(spark, str(tmp_path / root))
        assert listing.count() == 0 and tree.read_tree(listing.select("path", "length")).count() == 0
    for i in range(5000):
        put(tmp_path, f"flat/{i}", str(i).encode())
    monkeypatch.setattr(tree, "READ_BYTES", 1000)
    read = tree.read_tree(tree.list_tree(spark, str(tmp_path / "flat")).select("path", "length"))
    assert read.rdd.getNumPartitions() > 8
    assert read.where("content <> cast(regexp_extract(path, '([0-9]+)$', 1) as binary)").count() == 0
    assert read.count() == 5000


def test_folder_with_hidden_names_and_links(spark, tmp_path):
    root, outside = tmp_path / "root", tmp_path / "outside"
    for name in ("a.pdf", "_b.pdf", ".c.pdf", "_d/e.pdf", "_d/.f/long.pdf", "x.odd"):
        put(root, name, name.encode() * (50 if "long" in name else 1))
    put(outside, "secret.pdf")
    os.symlink(outside / "secret.pdf", root / "out.pdf")
    os.symlink(outside, root / "outs")
    os.symlink(root / "a.pdf", root / "in.pdf")
    os.symlink(root / "_d", root / "ins")
    os.symlink(root, root / "_d" / "loop")
    os.symlink(root / "gone", root / "broken.pdf")
    found = parse_folder(spark, str(root), Limits(max_input_bytes=100)).collect()
    got = {os.path.relpath(r.path.removeprefix("file:"), root): (r.error_code, r.error) for r in found}
    path = f"file:{root}"
    assert len(found) == len(got) and got == {
        **dict.fromkeys(["a.pdf", "_b.pdf", ".c.pdf", "_d/e.pdf", "in.pdf"], (None, None)),
        "_d/.f/long.pdf": ("input_rejected", "input is 700 bytes, over the 100-byte limit"),
        "x.odd": ("unsupported_format", "no reader for `.odd`"),
        "out.pdf": ("input_rejected", f"`{path}/out.pdf` leads out of its folder"),
        "outs": ("input_rejected", f"`{path}/outs` leads out of its folder"),
        "broken.pdf": ("input_rejected", f"cannot open `{path}/broken.pdf`"),
    }


def test_write_tree_again_leaves_one_whole_file(spark, tmp_path):
    rows = spark.createDataFrame([("_a/b.md", bytearray(b"1")), ("c", None)], "file string, content binary")
    for _ in range(2):
        tree.write_tree(rows, str(tmp_path / "t"))
    got = tree.read_tree(tree.list_tree(spark, str(tmp_path / "t")).select("path", "length")).collect()
    assert sorted((r.path.rsplit("/t/")[1], bytes(r.content)) for r in got) == [("_a/b.md", b"1"), ("c", b"")]


def test_output_trees_go_part_by_part(spark, small, monkeypatch):
    """Several parts give the rows of one, and leave no file of their trees."""
    from docloom.plans import queries

    roots = []
    write = tree.write_tree
    monkeypatch.setattr(tree, "write_tree", lambda rows, root: (roots.append(root), write(rows, root)))
    whole = sorted(map(str, queries.collect_outputs(spark, small).collect()))
    monkeypatch.setattr(queries, "TREE_FILES", 500)
    parted = queries.collect_outputs(spark, small)
    assert len(roots) == 1 + 3 and [os.listdir(r) for r in roots[1:]] == [[], [], []]
    assert sorted(map(str, parted.collect())) == whole


def test_scan_in_tasks_takes_no_listing_of_the_driver(spark, small, tmp_path):
    from docloom.plans import queries
    from docloom.sources import files

    for name in ("a.txt", "d/b.TXT", "d/c.pdf", "d/_e.txt", "x.txty"):
        put(tmp_path, name, name.encode())
    os.symlink(tmp_path / "a.txt", tmp_path / "link.txt")
    got = files.scan(spark, str(tmp_path), files.any_case_glob((".txt",)), in_tasks=True).collect()
    assert {os.path.relpath(r.path.removeprefix("file:"), tmp_path): bytes(r.content) for r in got} == {
        n: n.encode() for n in ("a.txt", "d/b.TXT", "d/_e.txt")
    }
    plan = queries.document_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "MapInArrow" in plan


def test_rows_of_one_id_have_a_file_each(spark, tmp_path):
    from docloom.plans import queries

    rows = [(1, "a"), (1, "b"), (1, "b"), (-2, None), (3, "x\ny")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.length) for r in queries.document_scan(spark, str(tmp_path)).collect())
    assert got == [(-2, 1), (1, 2), (1, 2), (1, 2), (3, 4)]


def test_requests_through_links(spark, tmp_path):
    root, outside = tmp_path / "root", tmp_path / "outside"
    put(root, "a.pdf")
    put(outside, "s.pdf")
    os.symlink(outside, root / "link")
    os.symlink(root, tmp_path / "alias")
    paths = [f"{root}/a.pdf", f"{root}/link/s.pdf", f"{tmp_path}/alias/a.pdf", f"{root}/new.pdf", f" {root}/a.pdf ", None, ""]
    asked = spark.createDataFrame(list(enumerate(paths)), "request_id int, path string").withColumn("content_base64", F.lit(None).cast("string"))
    roots = [str(root)]
    textual = {r.request_id: r.accepted for r in I.check_requests(asked, roots, 100).collect()}
    assert textual == {0: True, 1: True, 2: False, 3: True, 4: True, 5: False, 6: False}
    checked = I.check_requests(tree.real_paths(asked, "path", "real"), roots, 100, real_path=F.col("real"))
    assert {r.request_id: r.accepted for r in checked.collect()} == {0: True, 1: False, 2: True, 3: True, 4: True, 5: False, 6: False}
