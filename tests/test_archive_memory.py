"""What a task holds of archives does not grow with the table."""

import pandas as pd
from pyspark.sql import functions as F

from docloom.plans import inputs as inp
from docloom.sources import containers


def test_tasks_grow_with_the_bytes(spark, small, monkeypatch):
    def dealt():
        packed = inp.packed_archives(spark, small).withColumn("part", F.spark_partition_id())
        return packed.select("path", "part", F.md5("content").alias("digest")).collect()

    whole = dealt()
    monkeypatch.setattr(inp, "PACKED_BYTES", 1 << 14)
    cut = dealt()
    assert {(r.path, r.digest) for r in cut} == {(r.path, r.digest) for r in whole}
    most = pd.Series([r.part for r in cut]).value_counts().max()
    assert len({r.part for r in whole}) <= 4 < len({r.part for r in cut})
    assert most < pd.Series([r.part for r in whole]).value_counts().max()


def test_archives_come_one_by_one(spark, small):
    """Archives and entries pass as Arrow data; no frame holds a whole batch of them."""
    entries = containers.expand_archives(inp.packed_archives(spark, small), 100)
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    rows = [("a.zip", "zip", 0, "x", "file", 3, b"abc", None, None), ("b", "none", 0, "", "unreadable", 0, None, "input_rejected", "bad")]
    assert [tuple(r.values()) for r in containers._batch(rows).to_pylist()] == rows
    odd = spark.createDataFrame([("/x/a.zip", None), ("/x/b.tar", b""), ("/x/c", b"no archive")], "path string, content binary")
    found = containers.expand_archives(odd).collect()
    assert sorted(r.archive for r in found) == ["/x/a.zip", "/x/b.tar", "/x/c"]
    assert {r.error_code for r in found} == {"input_rejected"}
