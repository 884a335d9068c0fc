"""Result tables: full records for lookup, slim rows for listing."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docloom.session import delete, file_system


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "status", F.when(F.col("error_code").isNull(), "succeeded").otherwise("failed")
    )


def write_results(results: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet by status, so one state can be read without the others."""
    results.write.mode(mode).partitionBy("status").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Everything but the payload; the scan does not touch its columns."""
    return spark.read.parquet(path).drop("result")


# Committed batches.  A batch is written under a folder of its own attempt and becomes visible
# by one empty file, whose creation is atomic; of two attempts the earlier file counts.
MANIFEST = "_manifest"


def commit_results(results: DataFrame, path: str, batch: str) -> bool:
    """Adds a batch of ``with_status`` rows exactly once; False where it is there already.

    A job that fails half-way, or is run again, leaves nothing that readers see.  ``batch`` is
    the caller's name of the rows: letters, digits, ``-`` and ``_``.
    """
    if not batch or not batch.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"not a batch name: {batch!r}")
    spark = results.sparkSession
    if batch in committed(spark, path):
        return False
    attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    folder = f"{path}/batch={batch}/attempt={attempt}"
    results.write.partitionBy("status").parquet(folder)
    fs, mark = file_system(spark, f"{path}/{MANIFEST}/{batch}/{attempt}")
    fs.mkdirs(mark.getParent())
    fs.createNewFile(mark)
    if committed(spark, path)[batch] != attempt:  # another run of the batch was first
        delete(spark, folder)
        return False
    return True


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """The attempt that counts of every committed batch; one small listing of the manifest."""
    fs, where = file_system(spark, f"{path}/{MANIFEST}")
    found: dict[str, str] = {}
    if fs.exists(where):
        marks = fs.listFiles(where, True)
        while marks.hasNext():
            mark = marks.next().getPath()
            batch, attempt = mark.getParent().getName(), mark.getName()
            if not attempt.startswith("."):
                found[batch] = min(attempt, found.get(batch, attempt))
    return found


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All committed rows, with the columns of ``schema`` (that of the rows written)."""
    folders = [f"{path}/batch={b}/attempt={a}" for b, a in sorted(committed(spark, path).items())]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.select(*schema.names)


def clear_uncommitted(spark: SparkSession, path: str) -> int:
    """Removes what failed attempts left; call it while no batch is being written."""
    kept, gone = committed(spark, path), 0
    fs, root = file_system(spark, path)
    for batch in fs.globStatus(file_system(spark, f"{path}/batch=*")[1]) or []:
        name = batch.getPath().getName().removeprefix("batch=")
        for attempt in fs.listStatus(batch.getPath()):
            if attempt.getPath().getName() != f"attempt={kept.get(name)}":
                fs.delete(attempt.getPath(), True)
                gone += 1
    return gone


def commit_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """A stream of ``with_status`` rows, each of its batches committed exactly once.

    Batches go by their number, so a ``path`` belongs to one ``checkpoint``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        commit_results(batch, path, str(batch_id))

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger or {"availableNow": True})
        .start()
    )
