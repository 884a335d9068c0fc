import datetime as dt
import random

from pyspark.sql import functions as F

from docloom.operators import ledger as L

T0 = dt.datetime(2024, 1, 1)
EVENT = "job_id bigint, ts timestamp_ntz, seq bigint, status string"
JOB = "job_id bigint, status string, created_at timestamp_ntz, started_at timestamp_ntz, finished_at timestamp_ntz"
DONE = {"succeeded", "failed", "cancelled"}


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


def jobs(spark, *rows):
    return spark.createDataFrame([(i, s, *map(at, times)) for i, s, *times in rows], JOB)


def fold(events):
    job = None
    for ts, _, status in sorted(events):
        if job is None:
            job = ["queued", ts, None, None]
        if job[0] in DONE:
            continue
        if status in DONE:
            job[0], job[3] = status, ts
        elif status == "running" and job[2] is None:
            job[0], job[2] = status, ts
    return tuple(job)


def test_snapshots_match_a_replay(spark):
    rng = random.Random(2)
    logs = {j: [(at(rng.randint(0, 50)), s, rng.choice(["queued", "running", "running", *sorted(DONE)])) for s in range(rng.randint(1, 7))] for j in range(400)}
    df = spark.createDataFrame([(j, *e) for j, es in logs.items() for e in es], EVENT)
    for r in L.job_snapshots(df).collect():
        assert tuple(r)[1:] == fold(logs[r.job_id]), logs[r.job_id]


def test_deadline_runs_from_start(spark):
    df = jobs(spark, (1, "running", 0, 100, None), (2, "running", 0, 500, None), (3, "succeeded", 0, 10, 611),
              (4, "succeeded", 0, 10, 610), (5, "queued", 0, None, None), (6, "cancelled", 0, None, 5))
    got = {r.job_id: r for r in L.apply_deadline(df, F.lit(at(701)).cast("timestamp_ntz"), 600).collect()}
    assert [got[i].status for i in range(1, 7)] == ["failed", "running", "failed", "succeeded", "queued", "cancelled"]
    assert got[1].finished_at == at(700) and got[1].error_code == "timeout" and got[4].error_code is None


def test_cancels(spark):
    df = jobs(spark, (1, "queued", 0, None, None), (2, "running", 0, 5, None), (3, "succeeded", 0, 5, 8), (4, "succeeded", 0, 5, 30), (5, "running", 0, 15, None))
    asks = spark.createDataFrame([(i, at(s)) for i, s in [(1, 10), (2, 10), (2, 99), (3, 10), (4, 10), (5, 10), (9, 10)]], "job_id bigint, ts timestamp_ntz")
    got = {r.job_id: r for r in L.apply_cancels(df, asks).collect()}
    assert {i: got[i].cancel_outcome for i in got} == {1: "cancelled", 2: "cancelled", 3: "ignored", 4: "cancelled", 5: "cancelled", 9: "unknown"}
    assert got[1].started_at is None and got[2].started_at == at(5) and got[5].started_at is None
    assert got[2].finished_at == at(10) and got[3].status == "succeeded"


def evict(table, limit):
    kept = sorted(table, key=lambda r: (r[2], r[0]))
    while len(kept) > limit:
        oldest = next((r for r in kept if r[1] in DONE), None)
        if oldest is None:
            break
        kept.remove(oldest)
    return {r[0] for r in kept}


def test_retention_matches_eviction(spark):
    rng = random.Random(4)
    for n, limit in [(30, 10), (30, 40), (12, 4), (25, 0)]:
        table = [(i, rng.choice(["queued", "running", *sorted(DONE)]), rng.randint(0, 9), None, None) for i in range(n)]
        kept = L.retain_jobs(jobs(spark, *table), limit)
        assert {r.job_id for r in kept.collect()} == evict(table, limit)
    live = [(i, "running", i, 1, None) for i in range(9)]
    assert L.retain_jobs(jobs(spark, *live), 4).count() == 9


def test_retention_by_ranges(spark, monkeypatch):
    """With room for many jobs no task sorts them all; ties in time go by id."""
    monkeypatch.setattr(L, "TOP_ROWS", 3)
    monkeypatch.setattr(L, "RANGE_ROWS", 40)
    rng = random.Random(6)
    for n, limit in [(300, 100), (300, 299), (300, 301), (200, 60), (50, 45)]:
        table = [(i, rng.choice(["running", *sorted(DONE)]), rng.choice([3, rng.randint(0, 9)]), None, None) for i in range(n)]
        kept = L.retain_jobs(jobs(spark, *table), limit)
        assert {r.job_id for r in kept.collect()} == evict(table, limit)


def test_listing_and_lookup(spark):
    df = jobs(spark, (2, "queued", 5, None, None), (1, "queued", 5, None, None), (3, "queued", 1, None, None)).withColumn("result", F.lit("big"))
    listed = L.job_listing(df)
    assert "result" not in listed.columns and [r.job_id for r in listed.collect()] == [3, 1, 2]
    wanted = spark.createDataFrame([(1,), (7,)], "job_id bigint")
    assert {r.job_id: r.unknown for r in L.job_lookup(wanted, df).collect()} == {1: False, 7: True}


def test_details_come_along_and_survive_the_deadline(spark):
    rows = [
        (1, at(0), 0, "queued", "a.pdf", None, None, None),
        (1, at(5), 1, "failed", None, "parse_failed", "boom", None),
        (1, at(6), 2, "failed", None, "timeout", "late", None),
        (2, at(0), 0, "queued", None, None, None, None),
        (2, at(1), 1, "running", "b.pdf", None, None, None),
        (2, at(9), 2, "succeeded", "c.pdf", None, None, "text"),
        (3, at(1), 1, "running", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, f"{EVENT}, filename string, error_code string, error string, result string")
    late = L.apply_deadline(L.job_snapshots(df), F.lit(at(701)).cast("timestamp_ntz"), 600)
    got = {r.job_id: (r.status, r.filename, r.error_code, r.error, r.result) for r in late.collect()}
    assert got == {
        1: ("failed", "a.pdf", "parse_failed", "boom", None),
        2: ("succeeded", "b.pdf", None, None, "text"),
        3: ("failed", None, "timeout", "the parse exceeded its time budget", None),
    }
