"""Committed batches: whole or not there, and each once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docloom.sources import sinks

SCHEMA = "path string, error_code string, result string"


def rows(spark, *paths):
    return sinks.with_status(spark.createDataFrame([(p, None if p < "m" else "timeout", p) for p in paths], SCHEMA))


def read(spark, path):
    found = sinks.read_committed(spark, path, rows(spark).schema)
    assert found.columns == ["path", "error_code", "result", "status"]
    return sorted((r.path, r.status) for r in found.collect())


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "out")
    assert read(spark, path) == [] and sinks.committed(spark, path) == {}
    assert sinks.commit_results(rows(spark, "a", "z"), path, "01")
    assert not sinks.commit_results(rows(spark, "a", "z"), path, "01")
    assert sinks.commit_results(rows(spark, "a"), path, "1") and sinks.commit_results(rows(spark), path, "empty_1")
    assert read(spark, path) == [("a", "succeeded"), ("a", "succeeded"), ("z", "failed")]
    for name in ("", "a/b", ".."):
        with pytest.raises(ValueError):
            sinks.commit_results(rows(spark, "a"), path, name)


def test_half_a_batch_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "out")
    fails = rows(spark, "a", "b").withColumn("result", F.when(F.col("path") == "b", F.raise_error(F.lit("lost"))).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.commit_results(fails, path, "one")
    # Written whole, but its run ended before the commit.
    rows(spark, "q").write.partitionBy("status").parquet(f"{path}/batch=one/attempt=0")
    assert read(spark, path) == []
    assert sinks.commit_results(rows(spark, "a", "b"), path, "one")
    assert read(spark, path) == [("a", "succeeded"), ("b", "succeeded")]
    assert sinks.clear_uncommitted(spark, path) >= 1 and sinks.clear_uncommitted(spark, path) == 0
    assert len(read(spark, path)) == 2


def test_of_two_runs_at_once_one_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    assert sinks.commit_results(rows(spark, "a"), path, "x")
    real, calls = sinks.committed, []

    def late(*args):  # this run looked before the other's commit
        calls.append(1)
        return {} if len(calls) == 1 else real(*args)

    monkeypatch.setattr(sinks, "committed", late)
    assert not sinks.commit_results(rows(spark, "a"), path, "x")
    monkeypatch.undo()
    assert read(spark, path) == [("a", "succeeded")]


def test_a_stream_that_is_restarted(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = rows(spark).schema
    for turn in range(2):
        rows(spark, f"a{turn}", f"z{turn}").write.mode("append").parquet(source)
        for log in ("log", "log"):  # the second start finds nothing new
            arriving = spark.readStream.schema(schema).parquet(source)
            sinks.commit_stream(arriving, out, str(tmp_path / log)).awaitTermination()
    assert read(spark, out) == [("a0", "succeeded"), ("a1", "succeeded"), ("z0", "failed"), ("z1", "failed")]
