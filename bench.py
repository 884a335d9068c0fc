"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Each query
runs once to warm up and then ``BENCH_RUNS`` times; the best run counts.  Rows go
to the no-op sink, so every column is computed and nothing is collected.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

from docloom.plans.queries import all_queries
from docloom.session import build_session

HEADLINE = (
    "plain_text",
    "plain_text_html",
    "shared_budget",
    "result_record",
    "clip_bytes",
    "error_tail",
    "intake_requests",
    "inline_decode",
    "format_routing",
    "option_cleanup",
    "archive_caps",
    "repeated_names",
    "archive_assembly",
    "archive_result",
    "archive_expand",
    "parse_job_documents",
    "parse_job_archives",
    "pick_markdown",
    "page_count",
    "page_window",
    "no_output",
    "job_snapshot",
    "job_deadline",
    "job_cancel",
    "job_retention",
    "doc_stream",
    "job_stream",
)


def in_files(spark, sf_dir: str, files: int) -> str:
    """The tables as a cluster would have them, each in several files; untimed.

    A table given as one row group is one task, however many cores there are.
    """
    folder = tempfile.mkdtemp(prefix="docloom-bench-")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        table = spark.read.parquet(path)
        table.repartition(files).write.parquet(f"{folder}/{os.path.basename(path)}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "docloom-bench",
        master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    given, sf_dir = sf_dir, in_files(spark, sf_dir, int(cpus))
    times = {}
    for name in chosen:
        best = None
        for turn in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if turn > 0:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_docs, n_bytes = docs.selectExpr("count(*)", "sum(octet_length(text))").first()
    spark.stop()
    plain = times.get("plain_text")
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "plain_text_docs_per_sec": plain and round(n_docs / plain),
                "plain_text_mb_per_sec": plain and round(n_bytes / plain / 1e6, 1),
            }
        )
    )


if __name__ == "__main__":
    main()
