"""Jobs whose deadlines and retention fire by themselves, on event-time timers.

A keyed state holds the minima that decide a job.  A started job has a timer at its deadline:
when the watermark gets there and no end is known, ``failed`` with code ``timeout`` goes out,
with no further event of the job.  A finished job has one at the end of its retention, which
takes it out of the state.  Events are folded per job and Arrow batch before the shuffle, so a
job with a huge log sends few rows to its state's task.  A job's rows, state and changes are plain
rows: a data frame for each job would cost many times the work on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from docloom.operators import ledger as L
from docloom.operators.outcomes import TIMEOUT
from docloom.streaming.jobs import state_store

# Minima of a job: first event, first running event, first terminal event, all as
# microseconds; events of one time are ordered by number, then by state.
MINIMA = "created long, run long, run_seq long, end long, end_seq long, end_code long"
FORGOTTEN = "forgotten"
CHANGE = Row("job_id", "step", "status", "created_at", "started_at", "finished_at", "error_code")
_NAMES = [f.split()[0] for f in MINIMA.split(", ")]
_ORDER = {"created": ["created"], "run": ["run", "run_seq"], "end": ["end", "end_seq", "end_code"]}


def fold_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The minima of each job among ``job_id, at, seq, code`` rows, and its newest time.

    ``code``: 0 for a running event, 1 and on for a terminal state, null for others.
    """
    for f in batches:
        jobs = f.groupby("job_id", sort=False)["at"].agg(created="min", newest="max")
        for name, rows in (("run", f[f["code"] == 0]), ("end", f[f["code"] > 0])):
            first = rows.sort_values(["at", "seq", "code"]).drop_duplicates("job_id").set_index("job_id")
            jobs[name], jobs[f"{name}_seq"] = first["at"], first["seq"]
            if name == "end":
                jobs["end_code"] = first["code"]
        yield jobs.reset_index().astype({n: "Int64" for n in [*_NAMES, "newest"]})[["job_id", *_NAMES, "newest"]]


def merged(states: list[tuple]) -> tuple:
    """The minima of several states of one job."""
    out: dict[str, int | None] = {}
    for names in _ORDER.values():
        at = [_NAMES.index(n) for n in names]
        known = [tuple(s[i] for i in at) for s in states if s[at[0]] is not None]
        out.update(zip(names, min(known) if known else (None,) * len(names)))
    return tuple(out[n] for n in _NAMES)


class JobTimers(StatefulProcessor):
    """State and timers of one job; times are microseconds, timers milliseconds."""

    def __init__(self, timeout_secs: int, retention_secs: int | None):
        self.timeout = timeout_secs * 1_000_000
        self.retention = None if retention_secs is None else retention_secs * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("minima", MINIMA + ", step int")

    def _row(self, key: tuple, s: tuple, clock: int, step: int) -> Row:
        created, run, run_seq, end, end_seq, code = s
        started = run is not None and (end is None or (run, run_seq) < (end, end_seq))
        due = run + self.timeout if started else None
        late = due is not None and (end > due if end is not None else clock >= due)
        if step == 2:
            status = FORGOTTEN
        elif late:
            status = "failed"
        else:
            status = L.TERMINAL[code - 1] if end is not None else L.RUNNING if started else L.QUEUED
        finished = due if late else end
        return CHANGE(key[0], step, status, created, run if started else None, finished, TIMEOUT if late else None)

    def _finish(self, key: tuple, s: tuple, clock: int, step: int) -> Iterator[Row]:
        """Keeps and tells the state, and sets the timer that its next change waits for."""
        told = self._row(key, s, clock, step)
        if told.finished_at is not None:
            if self.retention is not None:
                self._at(told.finished_at + self.retention)
        elif told.started_at is not None:
            self._at(told.started_at + self.timeout)
        self.state.update((*s, step))
        yield told

    def _at(self, micros: int) -> None:
        # A timer fires once the watermark is past it; rounded up to whole milliseconds.
        self.handle.registerTimer(-(-micros // 1000) - 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.get()
        states = [tuple(known[:-1])] if known else []
        states += [tuple(r[n] for n in _NAMES) for r in rows]
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        yield from self._finish(key, merged(states), clock, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.state.get()
        if not known:
            return
        s, step = tuple(known[:-1]), known[-1]
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        finished = self._row(key, s, clock, 1).finished_at
        if finished is None:
            return  # a timer of a start that turned out to be void or later
        # An end past the deadline was told with its event.
        if step == 0 and s[_NAMES.index("end")] is None:
            yield from self._finish(key, s, clock, 1)
        if self.retention is not None and finished + self.retention <= clock:
            self.state.clear()
            yield self._row(key, s, clock, 2)

    def close(self) -> None:
        pass


def job_changes(
    events: DataFrame, timeout_secs: int, retention_secs: int | None = None, delay_secs: int = 10
) -> DataFrame:
    """The changes of jobs from a stream of ``job_id, ts, seq, status`` events.

    A row each time that events, the deadline (``step`` 1) or the retention (``step`` 2, status
    ``forgotten``) change a job.  Events older than the watermark, the newest event of earlier
    batches less ``delay_secs``, are too late and dropped; one that comes before it counts, in
    whatever order.  A job that is gone starts afresh with its next event.
    """
    job = events.schema["job_id"].dataType.simpleString()
    code = F.when(F.col("status") == L.RUNNING, 0)
    for n, name in enumerate(L.TERMINAL, 1):
        code = code.when(F.col("status") == name, n)
    placed = events.select(
        "job_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("seq").cast("long").alias("seq"), code.cast("long").alias("code")
    )
    folded = placed.mapInPandas(fold_batches, f"job_id {job}, {MINIMA}, newest long")
    clocked = folded.withColumn("newest", F.timestamp_micros("newest")).withWatermark("newest", f"{int(delay_secs)} seconds")
    fields = f"job_id {job}, step int, status string, created_at long, started_at long, finished_at long, error_code string"
    changes = clocked.groupBy("job_id").transformWithState(
        JobTimers(timeout_secs, retention_secs), fields, "Update", "EventTime"
    )
    return changes.withColumns({c: F.timestamp_micros(c) for c in ("created_at", "started_at", "finished_at")})


def start_job_timers(
    events: DataFrame, path: str, checkpoint: str, timeout_secs: int, retention_secs: int | None = None,
    delay_secs: int = 10, trigger: dict | None = None,
) -> StreamingQuery:
    """Writes ``job_changes`` under ``path``, a folder a batch that a rerun replaces."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    with state_store(events.sparkSession):
        return (
            job_changes(events, timeout_secs, retention_secs, delay_secs).writeStream
            .outputMode("update").foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger or {"availableNow": True})
            .start()
        )


def current_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The jobs that are not forgotten, each as its last change left it."""
    last = Window.partitionBy("job_id").orderBy(F.desc("batch"), F.desc("step"))
    rows = spark.read.parquet(path).withColumn("_n", F.row_number().over(last)).where(F.col("_n") == 1)
    return rows.where(F.col("status") != FORGOTTEN).drop("_n", "step", "batch")
