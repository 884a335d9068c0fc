import datetime as dt
import os
import random
import time

from docloom.limits import Limits
from docloom.operators import ledger as L
from docloom.operators.hook import decode_text
from docloom.plans.parse_job import parse_single
from docloom.sources import files
from docloom.streaming import documents as D
from docloom.streaming import jobs as J
from docloom.streaming import timers as T
from pyspark.sql import functions as F
from test_archive import zipped

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_document_stream_takes_each_file_once(spark, tmp_path):
    inbox, out, log = (str(tmp_path / d) for d in ("in", "out", "log"))
    (tmp_path / "in").mkdir()

    def drain():
        arriving = files.stream_documents(spark, inbox).select("path", F.col("content").cast("string").alias("markdown"))
        D.write_stream(D.shape_stream(arriving), out, log).awaitTermination()
        return sorted(r.result.text for r in spark.read.parquet(out).collect())

    (tmp_path / "in" / "a.pdf").write_text("# One")
    (tmp_path / "in" / "skip.txt").write_text("no")
    assert drain() == ["One"]
    (tmp_path / "in" / "b.PDF").write_text("**Two**")
    assert drain() == ["One", "Two"]


def test_many_small_files_run_no_listing_jobs(spark, tmp_path):
    """A batch of more files than Spark lists without a job costs its scan and no more tasks."""
    inbox, out, log = (str(tmp_path / d) for d in ("in", "out", "log"))
    (tmp_path / "in").mkdir()
    for i in range(450):
        (tmp_path / "in" / f"{i:03}.pdf").write_text(str(i))
    held = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before, tracker = spark.conf.get(held), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("", "")
    arriving = files.stream_documents(spark, inbox, files_per_batch=150)
    with D.many_files(spark):
        query = D.write_stream(arriving.select(F.col("content").cast("string").alias("n")), out, log)
        query.awaitTermination()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(query.runId) for s in tracker.getJobInfo(j).stageIds]
    assert len(tasks) == 3 and max(tasks) < 150 and spark.conf.get(held) == before
    assert sorted(int(r.n) for r in spark.read.parquet(out).collect()) == list(range(450))


def test_files_are_parsed_as_they_arrive(spark, tmp_path):
    inbox, out, log = (str(tmp_path / d) for d in ("in", "out", "log"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_text("# One")
    (tmp_path / "in" / "b.docx").write_text("# Two")
    arriving = files.stream_documents(spark, inbox).select("path", "content")
    D.write_stream(parse_single(arriving, Limits(), decode_text, office_readable=False), out, log).awaitTermination()
    got = {r.path[-6:]: (r.error_code, r.result and r.result.text) for r in spark.read.parquet(out).collect()}
    assert got == {"/a.pdf": (None, "One"), "b.docx": ("missing_dependency", None)}


def test_archives_are_joined_as_they_arrive(spark, tmp_path):
    inbox, out, log = (str(tmp_path / d) for d in ("in", "out", "log"))
    (tmp_path / "in").mkdir()
    for turn, name in enumerate(("a.zip", "b.zip")):
        (tmp_path / "in" / name).write_bytes(zipped(("2.pdf", b"two"), ("1.pdf", b"one")))
        arriving = files.stream_documents(spark, inbox, files.ARCHIVE_GLOB)
        D.write_archive_stream(arriving, out, log).awaitTermination()
        rows = spark.read.parquet(out).collect()
        assert len(rows) == turn + 1
        assert all(r.result.markdown == "# 1.pdf\n\none\n\n# 2.pdf\n\ntwo" for r in rows)


EVENT = "job_id bigint, ts timestamp, seq bigint, status string"


def feed(spark, inbox, events):
    rows = [(j, at(s), seq, status) for seq, (j, s, status) in events]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(inbox)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(inbox)


def folders(tmp_path):
    return [str(tmp_path / d) for d in ("in", "out", "log")]


def test_batches_do_not_matter(spark, tmp_path):
    """The same events in any order and any cut give the state of the ledger, compacted or not."""
    rng = random.Random(8)
    kinds = ["queued", "running", "running", "succeeded", "failed", "cancelled"]
    events = [(n, (rng.randint(1, 40), rng.randint(0, 4_000), rng.choice(kinds))) for n in range(300)]
    rng.shuffle(events)
    inbox, out, log = folders(tmp_path)
    for n, part in enumerate([events[:20], events[20:21], events[21:200], events[200:]]):
        J.start_job_fold(feed(spark, inbox, part), out, log).awaitTermination()
        if n == 1:
            J.compact_folds(spark, out)
            assert sorted(os.listdir(out)) == ["base-1"]
    rows = [(j, at(s), seq, status) for seq, (j, s, status) in events]
    clock = F.lit(max(at(s) for _, (_, s, _) in events) - dt.timedelta(seconds=1))
    whole = J.timed(L.job_snapshots(spark.createDataFrame(rows, EVENT)), clock, 600)
    want = {r.job_id: tuple(r)[1:] for r in whole.collect()}
    for _ in range(2):
        assert {r.job_id: tuple(r)[1:] for r in J.latest_jobs(spark, out, 600, 1).collect()} == want
        J.compact_folds(spark, out)
    assert sorted(os.listdir(out)) == ["base-3"]


def written(*tops):
    """Files and their sizes."""
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for top in tops for d, _, fs in os.walk(top) for f in fs}


def test_a_batch_writes_what_it_changed(spark, tmp_path):
    """After a large ledger, a few events cost a few bytes: folds and checkpointed state."""
    inbox, out, log = folders(tmp_path)
    J.start_job_fold(feed(spark, inbox, [(n, (n, n, "running")) for n in range(30_000)]), out, log).awaitTermination()
    before = written(out, log)
    J.start_job_fold(feed(spark, inbox, [(n, (n * 100, 50_000, "succeeded")) for n in range(5)]), out, log).awaitTermination()
    fresh = {f: n for f, n in written(out, log).items() if f not in before}
    assert 0 < sum(fresh.values()) < sum(before.values()) / 10
    changed = spark.read.parquet(f"{out}/delta-1")
    assert sorted(r.job_id for r in changed.collect()) == [0, 100, 200, 300, 400]
    done = J.latest_jobs(spark, out, 10**6).where("status = 'succeeded'")
    assert done.count() == 5
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_broken_batch_is_not_read(spark, tmp_path):
    inbox, out, log = folders(tmp_path)
    J.start_job_fold(feed(spark, inbox, [(0, (1, 0, "running"))]), out, log).awaitTermination()
    (tmp_path / "out" / "delta-1").mkdir()
    (tmp_path / "out" / "delta-1" / "part-0.parquet").write_bytes(b"half")
    assert [r.status for r in J.latest_jobs(spark, out, 10**6).collect()] == ["running"]


def time_jobs(spark, tmp_path, batches, retention=None, delay=1):
    """The changes each feed of events brought, and the jobs after it."""
    inbox, out, log = folders(tmp_path)
    seen, numbers = [], set()
    for events in batches:
        T.start_job_timers(feed(spark, inbox, list(enumerate(events))), out, log, 600, retention, delay).awaitTermination()
        rows = spark.read.parquet(out)
        fresh = rows.where(~F.col("batch").isin(*numbers)) if numbers else rows
        changes = {(r.job_id, r.status) for r in fresh.collect()}
        numbers |= {r.batch for r in rows.select("batch").distinct().collect()}
        seen.append((changes, {r.job_id: r for r in T.current_jobs(spark, out).collect()}))
    return seen


def state(jobs, j):
    gone = jobs[j].finished_at
    return jobs[j].status, gone and (gone.replace(tzinfo=None) - T0.replace(tzinfo=None)).total_seconds(), jobs[j].error_code


def test_deadlines_fire_by_themselves(spark, tmp_path):
    feeds = [
        [(1, 0, "queued"), (1, 1, "running"), (2, 0, "queued"), (2, 5, "cancelled"), (2, 6, "running"), (3, 2, "running"), (4, 3, "running"), (4, 700, "failed"), (8, 30, "running")],
        # Job 3's end is old, but its deadline has not been reached: it wins.
        [(3, 500, "succeeded"), (5, 590, "queued")],
        # The clock passes the deadlines of jobs 1 and 8, which have told nothing more.
        [(5, 900, "running")],
        [(1, 950, "succeeded"), (6, 1_500, "queued")],
        [(6, 9_000, "queued")],
        [(2, 9_001, "running"), (5, 9_002, "running")],
    ]
    one, two, three, four, five, six = time_jobs(spark, tmp_path, feeds, retention=5_000, delay=300)
    assert state(one[1], 1) == ("running", None, None) and state(one[1], 2) == ("cancelled", 5, None)
    assert state(one[1], 4) == ("failed", 603, "timeout")  # its end came past its budget
    assert state(two[1], 3) == ("succeeded", 500, None) and state(two[1], 5) == ("queued", None, None)
    # The clock stands at 600 after the third feed and at 1,200 after the fourth.
    assert three[0] >= {(5, "running")} and state(three[1], 8) == ("running", None, None)
    assert four[0] >= {(8, "failed"), (1, "failed")}
    assert state(four[1], 8) == ("failed", 630, "timeout") and state(four[1], 1) == ("failed", 601, "timeout")
    assert state(four[1], 5) == ("running", None, None)
    # At 8,700 the deadline of job 5 and the retention of all that ended by 3,700 are over.
    assert five[0] >= {(5, "failed"), (5, "forgotten"), (3, "forgotten"), (8, "forgotten")} and set(five[1]) == {6}
    assert state(six[1], 2) == ("running", None, None) and state(six[1], 5) == ("running", None, None)


def test_timers_agree_with_the_ledger(spark, tmp_path):
    """Events in any order and any cut that are not too late give the ledger's jobs."""
    rng = random.Random(9)
    kinds = ["queued", "running", "running", "succeeded", "failed", "cancelled"]
    events = [(n, (rng.randint(1, 30), rng.randint(0, 3_000), rng.choice(kinds))) for n in range(200)]
    rng.shuffle(events)
    inbox, out, log = folders(tmp_path)
    for part in [events[:15], events[15:16], events[16:]]:
        T.start_job_timers(feed(spark, inbox, part), out, log, 600, None, 3_000).awaitTermination()
    last = (300, (99, 20_000, "queued"))  # takes the clock past every deadline
    T.start_job_timers(feed(spark, inbox, [last]), out, log, 600, None, 3_000).awaitTermination()
    rows = [(j, at(s), seq, status) for seq, (j, s, status) in [*events, last]]
    whole = J.timed(L.job_snapshots(spark.createDataFrame(rows, EVENT)), F.lit(at(17_000)), 600)
    assert {r.job_id: tuple(r)[1:] for r in T.current_jobs(spark, out).collect()} == {r.job_id: tuple(r)[1:] for r in whole.collect()}


def test_a_job_costs_no_data_frame():
    """Many jobs of a row each pass through the timers' processor in plain rows."""
    from pyspark.sql import Row

    class Held:
        value = None
        get = lambda self: self.value
        update = lambda self, value: setattr(self, "value", value)

    class Clock:
        registerTimer = lambda self, at: None
        getCurrentWatermarkInMs = lambda self: 0

    told, began = [], time.monotonic()
    for n in range(20_000):
        jobs = T.JobTimers(600, None)
        jobs.handle, jobs.state = Clock(), Held()
        row = Row(job_id=n, created=5, run=7, run_seq=1, end=None, end_seq=None, end_code=None, newest=7)
        told += jobs.handleInputRows((n,), iter([row]), Clock())
    assert time.monotonic() - began < 8  # frames took over a millisecond each
    assert isinstance(told[3], Row) and tuple(told[3]) == (3, 0, "running", 5, 7, None, None)


def test_a_hot_job_is_folded_before_its_state():
    import pandas as pd

    rows = pd.DataFrame([(1, n, n, 0 if n % 2 else 1 + n % 3) for n in range(5, 1000)], columns=["job_id", "at", "seq", "code"])
    (out,) = T.fold_batches([rows.sample(frac=1, random_state=1)])
    assert out.values.tolist() == [[1, 5, 5, 5, 6, 6, 1, 999]]
    (out,) = T.fold_batches([pd.DataFrame([(2, 7, 1, None)], columns=["job_id", "at", "seq", "code"]).astype({"code": "float"})])
    assert out["created"].tolist() == [7] and out[["run", "end", "end_code"]].isna().all(axis=None)


def test_streams_run_under_any_trigger(spark, tmp_path):
    inbox, out, log = folders(tmp_path)
    arriving = feed(spark, inbox, [(0, (1, 0, "running"))])
    query = J.start_job_fold(arriving, out, log, {"processingTime": "1 second"})
    for _ in range(100):
        if os.path.exists(f"{out}/delta-0/_SUCCESS"):
            break
        time.sleep(0.2)
    assert query.isActive
    query.stop()
    assert J.latest_jobs(spark, out, 10**6).count() == 1
