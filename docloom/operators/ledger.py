"""The job ledger: one row per job, folded from an event log.

Events: ``job_id, ts, seq, status`` and optionally ``filename, error_code, error,
missing_dependencies, result``.  ``(ts, seq)`` orders the events of a job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.outcomes import TIMEOUT, TIMEOUT_MESSAGE
from docloom.session import staged

# The states of a job.
QUEUED, RUNNING = "queued", "running"
TERMINAL = ("succeeded", "failed", "cancelled")


# What an event may also tell of its job: the file, and how the job ended.
FILE_DETAIL = "filename"
END_DETAILS = ("error_code", "error", "missing_dependencies", "result")
_CODES = ("", *TERMINAL)


def _place(ts: Column, seq: Column, status: Column) -> Column:
    """Time, sequence number and state in one number, ordered as the pair is.

    A minimum over a number is kept in a hash table; over a struct it takes a sort.
    """
    code = F.lit(0)
    for n, name in enumerate(TERMINAL, 1):
        code = F.when(status == name, n).otherwise(code)
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(38,0)")
    return micros * F.lit(Decimal(10) ** 20).cast("decimal(21,0)") + (
        seq.cast("decimal(19,0)") * F.lit(10).cast("decimal(2,0)") + code
    ).cast("decimal(38,0)")


def fold_events(events: DataFrame, *more: Column) -> DataFrame:
    """The minima of each job's events that decide its state.

    They combine before the shuffle, so one job with a huge log is spread over the map
    side, and in any order, so folds of parts can be merged.  ``seq`` is not negative.
    """
    at = _place(F.col("ts"), F.col("seq"), F.col("status"))
    running, ending = F.col("status") == RUNNING, F.col("status").isin(*TERMINAL)
    return events.withColumn("_at", at).groupBy("job_id").agg(
        F.min("ts").alias("created_at"),
        F.min(F.when(running, F.col("_at"))).alias("run"),
        F.min(F.when(running, F.col("ts"))).alias("run_ts"),
        F.min(F.when(ending, F.col("_at"))).alias("end"),
        F.min(F.when(ending, F.col("ts"))).alias("end_ts"),
        *more,
    )


def finish(folded: DataFrame, *more: str) -> DataFrame:
    """Job states from their minima: the first terminal state wins, later ones are void."""
    started = F.col("run").isNotNull() & (F.col("end").isNull() | (F.col("run") < F.col("end")))
    ended = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("end") % 10).cast("int") + 1)
    return folded.select(
        "job_id",
        F.coalesce(
            F.when(F.col("end").isNotNull(), ended), F.when(started, F.lit(RUNNING)), F.lit(QUEUED)
        ).alias("status"),
        "created_at",
        F.when(started, F.col("run_ts")).alias("started_at"),
        F.col("end_ts").alias("finished_at"),
        *more,
    )


def job_snapshots(events: DataFrame) -> DataFrame:
    """One row per job.

    Where the events carry them, the first ``filename`` told comes along, and ``error_code,
    error, missing_dependencies, result`` of the terminal event.
    """
    first_told = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c)
        for c in events.columns
        if c == FILE_DETAIL
    ]
    folded = fold_events(events, *first_told)
    told = [c for c in END_DETAILS if c in events.columns]
    if told:  # the details of the winning events only, not a fold over all of them
        at = _place(F.col("ts"), F.col("seq"), F.col("status"))
        ends = events.filter(F.col("status").isin(*TERMINAL)).select("job_id", at.alias("end"), *told)
        folded = folded.join(ends.dropDuplicates(["job_id", "end"]), ["job_id", "end"], "left")
    return finish(folded, *[c for c in (FILE_DETAIL, *END_DETAILS) if c in events.columns])


def job_listing(jobs: DataFrame) -> DataFrame:
    """All jobs in submission order, without their results."""
    return jobs.drop("result").orderBy("created_at", "job_id")


def job_lookup(wanted: DataFrame, jobs: DataFrame) -> DataFrame:
    """Jobs by id; an id the ledger does not know is a row saying so."""
    found = jobs.withColumn("_known", F.lit(True))
    return (
        wanted.select("job_id").join(found, "job_id", "left")
        .withColumn("unknown", F.col("_known").isNull())
        .drop("_known")
    )


def seconds(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000)


def apply_deadline(jobs: DataFrame, now: Column, timeout_secs: int) -> DataFrame:
    """Jobs past their budget become ``failed``; it runs from start, not submit.

    Errors that other jobs carry stay as they are.
    """
    ran = seconds(F.coalesce("finished_at", now)) - seconds(F.col("started_at"))
    late = F.coalesce(ran > timeout_secs, F.lit(False))
    due = F.col("started_at") + F.expr(f"interval {int(timeout_secs)} seconds")

    def told(name: str) -> Column:
        return F.col(name) if name in jobs.columns else F.lit(None).cast("string")

    return (
        jobs.withColumn("_late", late)
        .withColumn("status", F.when(F.col("_late"), "failed").otherwise(F.col("status")))
        .withColumn("finished_at", F.when(F.col("_late"), due).otherwise(F.col("finished_at")))
        .withColumn("error_code", F.when(F.col("_late"), TIMEOUT).otherwise(told("error_code")))
        .withColumn("error", F.when(F.col("_late"), TIMEOUT_MESSAGE).otherwise(told("error")))
        .drop("_late")
    )


def apply_cancels(jobs: DataFrame, cancels: DataFrame) -> DataFrame:
    """Applies the first cancel request of each job (``job_id, ts``).

    Terminal jobs are left alone, queued ones never start, and a request for an
    unknown job is a row with ``cancel_outcome = 'unknown'``.
    """
    first = cancels.groupBy("job_id").agg(F.min("ts").alias("_asked"))
    both = jobs.withColumn("_known", F.lit(True)).join(first, "job_id", "full")
    asked = F.col("_asked")
    live = F.col("finished_at").isNull() | (asked < F.col("finished_at"))
    outcome = (
        F.when(asked.isNull(), F.lit(None).cast("string"))
        .when(F.col("_known").isNull(), F.lit("unknown"))
        .when(live, F.lit("cancelled"))
        .otherwise(F.lit("ignored"))
    )
    hit = F.coalesce(F.col("cancel_outcome") == "cancelled", F.lit(False))
    return (
        both.withColumn("cancel_outcome", outcome)
        .withColumn("status", F.when(hit, F.lit("cancelled")).otherwise(F.col("status")))
        .withColumn(
            "started_at", F.when(~(hit & (asked <= F.col("started_at"))), F.col("started_at"))
        )
        .withColumn("finished_at", F.when(hit, asked).otherwise(F.col("finished_at")))
        .drop("_known", "_asked")
    )


# Up to so many jobs are picked as one top-k; more are ranked by ranges of this size.
TOP_ROWS = 100_000
RANGE_ROWS = 500_000


def retain_jobs(jobs: DataFrame, max_jobs: int) -> DataFrame:
    """Drops the oldest terminal jobs while over ``max_jobs``; live ones stay.

    The ledger is written first, as it is read twice.  Dropping the oldest
    ``n - max_jobs`` terminal jobs keeps the newest ``max_jobs - live`` of them, so the
    oldest key that stays is found among slim ``(created_at, job_id)`` keys; rows with
    payload are only filtered by it.
    """
    jobs = staged(jobs, "ledger")
    terminal = F.col("status").isin(*TERMINAL)
    live, done = jobs.agg(F.count_if(~terminal), F.count_if(terminal)).first()
    room = max(max_jobs - live, 0)
    if not room:
        return jobs.where(~terminal)
    if room >= done:
        return jobs
    key = _oldest_kept(jobs.where(terminal).select("created_at", "job_id"), room, done).scalar()
    return jobs.where(~terminal | (F.struct("created_at", "job_id") >= key))


def _oldest_kept(keys: DataFrame, room: int, total: int) -> DataFrame:
    """The ``room``-th newest key, a row of one struct.

    A small ``room`` is a top-k that every task cuts down first.  For a large one the keys are
    dealt out by ranges, newest first; the counts of the ranges tell which of them holds the
    key, and only that one, about ``RANGE_ROWS`` keys, is sorted.
    """
    newest = [F.desc("created_at"), F.desc("job_id")]
    if room > TOP_ROWS:
        parts = -(-total // RANGE_ROWS)
        ranged = staged(
            keys.repartitionByRange(parts, *newest).withColumn("range", F.spark_partition_id()), "ledger-ranges"
        )
        for at, n in sorted(ranged.groupBy("range").count().collect()):  # one row per range
            if room <= n:
                break
            room -= n
        keys = ranged.where(F.col("range") == at)
    kept = keys.select("created_at", "job_id").orderBy(*newest).limit(room)
    return kept.agg(F.min(F.struct("created_at", "job_id")).alias("key")).select("key")
