"""Documents shaped as they arrive.  Stateless, so it scales like a scan."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.functions.names import base_name
from docloom.functions.options import DEFAULT_BACKEND
from docloom.limits import Limits
from docloom.operators import outcomes as X
from docloom.operators.hook import Parser, decode_text
from docloom.operators.results import shape_results
from docloom.plans.parse_job import parse_archives
from docloom.session import settings

# The files of a batch are known by name, so no job is run to list them; the log of files seen
# is merged into one now and then only, as each merge writes all of it again.  No batch asks again
# for the files of one before, so the driver keeps none of their states.
FILE_SOURCE = {
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000",
    "spark.sql.streaming.fileSource.log.compactInterval": "200",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}
# Some hundred small files make a task, not each 32 of them.
SHARED_CORES = {"spark.sql.files.openCostInBytes": str(256 << 10)}


def many_files(spark: SparkSession):
    """For streams of small files: the settings hold while the context is open.

    The file source asks its session for them in every batch, so the query should end inside.  A
    stream begun inside goes on inside only: its log of files is merged at other batches.
    """
    return settings(spark, FILE_SOURCE)


def shape_stream(
    arriving: DataFrame, limits: Limits = Limits(), office_readable: bool = True
) -> DataFrame:
    """``path, markdown`` rows to typed results."""
    name = base_name(F.col("path"))
    none = F.array().cast("array<string>")
    ready = (
        arriving.withColumn("failure", X.preflight(name, office_readable))
        .withColumn("filename", name)
        .withColumn("error_code", F.col("failure.error_code"))
        .withColumn("error", F.col("failure.error"))
        .withColumn("missing_dependencies", F.coalesce("failure.missing_dependencies", none))
        .withColumn("warnings", none)
        .withColumn("sources", F.array("filename"))
        .withColumn("page_count", F.lit(None).cast("bigint"))
        .withColumn("over_budget", F.lit(False))
        .withColumn("parse_backend", F.lit(DEFAULT_BACKEND))
        .drop("failure")
    )
    return shape_results(ready, limits.max_output_bytes, limits.min_text_bytes)


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Takes everything that has arrived and stops, or runs under ``trigger``.

    The file sink's own log makes a restarted batch replace itself.
    """
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger or {"availableNow": True})
        .start(path)
    )


def write_streams(streams: Sequence[DataFrame], path: str, checkpoint: str) -> DataFrame:
    """Takes what has arrived on all streams, side by side, and reads it back.

    Most of a small batch's time goes into the stream's own log, where a cluster idles; each
    stream has a log of its own.  A batch takes its share of the cores, so that its tasks are
    few and long.  All streams stop once one fails.
    """
    spark = streams[0].sparkSession
    cores = -(-spark.sparkContext.defaultParallelism // len(streams))
    with settings(spark, {**SHARED_CORES, "spark.sql.files.minPartitionNum": str(cores)}):
        out = _run_streams(streams, path, checkpoint)
    # A folder at a time: each has the list of its files.
    return functools.reduce(DataFrame.unionAll, [spark.read.schema(s.schema).parquet(p) for s, p in zip(streams, out)])


def _run_streams(streams: Sequence[DataFrame], path: str, checkpoint: str) -> list[str]:
    out = [f"{path}/share={n}" for n in range(len(streams))]
    running: list[StreamingQuery] = []
    try:
        for n, stream in enumerate(streams):
            running.append(write_stream(stream, out[n], f"{checkpoint}/{n}"))
        waiting = running
        while waiting:
            waiting[0].awaitTermination(1)
            waiting = [query for query in running if query.isActive]
            for query in running:
                if not query.isActive:
                    query.awaitTermination()  # raises what went wrong
    finally:
        for query in running:
            query.stop()
    return out


def write_archive_stream(
    arriving: DataFrame,
    path: str,
    checkpoint: str,
    limits: Limits = Limits(),
    parser: Parser = decode_text,
    office_readable: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archives (``path, content``) as they arrive, each batch a whole job.

    An archive arrives in one file, so its members never span batches.  Every
    batch owns a folder named after it, which a rerun replaces.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        results = parse_archives(batch.select("path", "content"), limits, parser, office_readable)
        results.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        arriving.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger or {"availableNow": True})
        .start()
    )
