"""Streams of a lot of files end, and the driver forgets them, before those of the next begin."""

import os

from docloom.plans import queries
from docloom.streaming import documents as D


def test_files_come_in_lots(spark, small, monkeypatch):
    runs, write = [], D.write_streams
    cache = "spark.sql.hive.filesourcePartitionFileCacheSize"
    before = spark.conf.get(cache)

    def watched(streams, path, checkpoint):
        # No stream of another lot is running, and batches keep no states of files.
        assert not spark.streams.active and int(spark.conf.get(cache)) == 0
        found = write(streams, path, checkpoint)
        runs.append((path, checkpoint, found.count(), len(streams)))
        return found

    monkeypatch.setattr(queries, "write_streams", watched)
    whole = sorted(map(str, queries.document_stream(spark, small).collect()))
    assert [r[2:] for r in runs] == [(200, 5)] and spark.conf.get(cache) == before
    monkeypatch.setattr(queries, "LOT_FILES", 45)
    assert sorted(map(str, queries.document_stream(spark, small).collect())) == whole
    assert sum(r[2] for r in runs[1:]) == 200 and [r[3] for r in runs[1:]] == [10, 10, 5]
    assert all(r[2] < 150 for r in runs[1:])
    assert len({r[0] for r in runs}) == len({r[1] for r in runs}) == len(runs)


def test_rows_of_one_id_are_in_many_lots(spark, tmp_path):
    rows = [(7, str(n)) for n in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    root = queries._document_files(spark, str(tmp_path), lots=4)
    held = [sum(len(names) for _, _, names in os.walk(f"{root}/lot={n}")) for n in range(4)]
    assert sum(held) == 400 and max(held) < 200
