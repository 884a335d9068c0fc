"""Live job state: the ledger's fold kept up to date batch by batch.

Spark's own streaming aggregation keeps the minima of every job in its state store; a batch
writes the folds of the jobs it touched and no others.  Minima depend neither on the order
of events nor on how they were cut into batches, so the folds written so far, merged, are
the fold of all events.  Deadlines are columns against the stream's clock: the newest event
time less a delay.  ``streaming.timers`` has jobs whose deadlines fire by themselves.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators import ledger as L
from docloom.operators.outcomes import TIMEOUT
from docloom.session import delete, exists, file_system

FOLD = ("created_at", "run", "run_ts", "end", "end_ts")
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextlib.contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """A query started inside keeps its state on disk and checkpoints what a batch changed.

    A query takes the session's settings over when it starts, so they are put back after.
    """
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def merge_folds(folds: DataFrame) -> DataFrame:
    """One row per job from any number of partial folds."""
    newest = [F.max("newest").alias("newest")] if "newest" in folds.columns else []
    return folds.groupBy("job_id").agg(*[F.min(c).alias(c) for c in FOLD], *newest)


def timed(jobs: DataFrame, clock: Column, timeout_secs: int) -> DataFrame:
    """Snapshots with the deadlines that have passed by ``clock``."""
    due = F.col("started_at") + F.expr(f"interval {int(timeout_secs)} seconds")
    open_late = F.col("finished_at").isNull() & (clock >= due)
    late = F.coalesce(open_late | (F.col("finished_at") > due), F.lit(False))
    return jobs.select(
        "job_id",
        F.when(late, "failed").otherwise(F.col("status")).alias("status"),
        "created_at",
        "started_at",
        F.when(late, due).otherwise(F.col("finished_at")).alias("finished_at"),
        F.when(late, TIMEOUT).alias("error_code"),
    )


def start_job_fold(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the folds of ``job_id, ts, seq, status`` events under ``path``.

    Each batch owns a folder with the folds of the jobs that its events touched; a rerun
    replaces it.  ``trigger``: arguments of ``writeStream.trigger``; by default all that has
    arrived is taken and the query ends.
    """
    folds = L.fold_events(events, F.max("ts").alias("newest"))

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/delta-{batch_id}")

    with state_store(events.sparkSession):
        return (
            folds.writeStream.outputMode("update").foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger or {"availableNow": True})
            .start()
        )


def _folders(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The newest whole base (-1: none) and the numbers of the whole deltas after it."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return -1, []
    names = [f.getPath().getName() for f in fs.listStatus(where)]
    found: dict[str, list[int]] = {"base": [], "delta": []}
    for name in names:
        part = re.fullmatch(r"(base|delta)-(\d+)", name)
        if part and exists(spark, f"{path}/{name}/_SUCCESS"):
            found[part[1]].append(int(part[2]))
    base = max(found["base"], default=-1)
    return base, sorted(n for n in found["delta"] if n > base)


def latest_folds(spark: SparkSession, path: str) -> DataFrame:
    """One row per job: its minima and the time of its newest event."""
    base, deltas = _folders(spark, path)
    read = [f"{path}/base-{base}"] * (base >= 0) + [f"{path}/delta-{n}" for n in deltas]
    if not read:
        raise FileNotFoundError(f"no batch has been written under {path}")
    return merge_folds(spark.read.parquet(*read))


def compact_folds(spark: SparkSession, path: str) -> None:
    """Merges the base and all whole deltas into a new base, then drops what it replaces.

    For every so many batches, so that a reader meets few of them.  Folding a delta twice
    changes nothing, so a run that breaks off, or a reader in between, does no harm as long
    as no reader that began before still needs the old folders.
    """
    base, deltas = _folders(spark, path)
    if not deltas:
        return
    latest_folds(spark, path).write.mode("overwrite").parquet(f"{path}/base-{deltas[-1]}")
    for gone in [f"base-{base}"] * (base >= 0) + [f"delta-{n}" for n in deltas]:
        delete(spark, f"{path}/{gone}")


def latest_jobs(spark: SparkSession, path: str, timeout_secs: int, delay_secs: int = 10) -> DataFrame:
    """The jobs as of the newest batch; the clock stands ``delay_secs`` before the newest event."""
    folds = latest_folds(spark, path)
    delay = F.expr(f"interval {int(delay_secs)} seconds")
    clock = F.lit(folds.agg((F.max("newest") - delay).alias("clock")).first()[0])
    return timed(L.finish(folds), clock.cast(folds.schema["newest"].dataType), timeout_secs)
