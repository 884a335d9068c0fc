"""A stream for each share of the folders takes every file once, whatever the shares hold."""

import fnmatch

import pytest
from pyspark.sql import functions as F

from docloom.plans.queries import FOLDER_SHARES
from docloom.sources import files
from docloom.streaming import documents as D


def test_any_folder_is_in_one_share():
    for name in [f"part={n}" for n in range(256)] + ["doc_id=-7", "doc_id=__HIVE_DEFAULT_PARTITION__", "x", "_9", "é"]:
        assert sum(fnmatch.fnmatchcase(name, share) for share in FOLDER_SHARES) == 1, name


def test_streams_side_by_side(spark, tmp_path):
    names = [f"part={n}/d{k}.txt" for n in (0, 1, 2, 13, 255) for k in range(12)] + ["other/z.txt"]
    for name in names:
        at = tmp_path / "in" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(name)
    shares = [files.stream_documents(spark, f"{tmp_path}/in/{s}", "*.txt", files_per_batch=5) for s in FOLDER_SHARES]
    with D.many_files(spark):
        found = D.write_streams([s.select(F.col("content").cast("string").alias("text")) for s in shares], f"{tmp_path}/out", f"{tmp_path}/log")
    assert sorted(r.text for r in found.collect()) == sorted(names)
    empty = [i for i, s in enumerate(FOLDER_SHARES) if s == "*[67]"]
    assert spark.read.schema("text string").parquet(f"{tmp_path}/out/share={empty[0]}").count() == 0


def test_one_failure_ends_all(spark, tmp_path):
    for name in ("part=0/a.txt", "part=2/b.txt"):
        at = tmp_path / "in" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(name)
    whole = files.stream_documents(spark, f"{tmp_path}/in/*[01]", "*.txt").select("path")
    broken = files.stream_documents(spark, f"{tmp_path}/in/*[23]", "*.txt").select(F.raise_error(F.lit("broken file")).cast("string").alias("path"))
    with pytest.raises(Exception, match="broken file"):
        D.write_streams([whole, broken], f"{tmp_path}/out", f"{tmp_path}/log")
    assert not spark.streams.active
