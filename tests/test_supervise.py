"""The parser's child: ended when its time is up, with all it has started."""

import functools
import os
import time

import pytest
from pyspark import cloudpickle

from docloom.limits import Limits
from docloom.operators.hook import _attempt
from docloom.operators.supervise import Supervised, descendants
from docloom.plans.parse_job import parse_archives, parse_single
from test_archive import zipped


def make_parser():
    """A closure, so that it travels by value."""

    def parser(name, content, options):
        import os
        import signal
        import subprocess
        import sys
        import time

        text = content.decode()
        if text == "hang":
            time.sleep(1000)
        if text == "stubborn":  # ignores the first signal, as does its child in a session of its own
            signal.signal(signal.SIGTERM, signal.SIG_IGN)
            code = "import signal, time; signal.signal(signal.SIGTERM, signal.SIG_IGN); time.sleep(1000)"
            subprocess.Popen([sys.executable, "-c", code], start_new_session=True)
            time.sleep(1000)
        if text.startswith("exit"):
            print("x" * 100_000)
            print("last words", file=sys.stderr, flush=True)
            os._exit(int(text[4:]))
        if text == "killed":
            os.kill(os.getpid(), signal.SIGKILL)
        if text == "loud":
            print("y" * 1_000_000)
        if text == "stdin":
            return sys.stdin.read() or "nothing to read", 1
        if text == "bad":
            raise ValueError("oops")
        return text.upper(), os.getpid()

    return parser


@pytest.fixture
def child():
    made = Supervised(cloudpickle.dumps(functools.partial(_attempt, make_parser())), 1.0, 0.5)
    yield made
    made.stop()


def below():
    """Live processes that descend from this one, the JVM and its own left out."""
    return {p for p, _ in descendants(os.getpid()) if b"-c" in open(f"/proc/{p}/cmdline", "rb").read().split(b"\0")[:2]}


def test_one_child_serves_many(child):
    before = below()
    first, second = child("a.pdf", b"one", None), child("b.pdf", b"two", "{}")
    assert (first[0], second[0]) == ("ONE", "TWO") and first[1] == second[1]
    assert child("c.pdf", b"bad", None)[2:] == ("parse_failed", "ValueError: oops")
    assert child("c.pdf", b"loud", None)[0] == "LOUD"
    assert child("c.pdf", b"stdin", None)[0] == "nothing to read"
    assert child("d.pdf", b"z" * 30_000_000, None)[0] == "Z" * 30_000_000
    assert child("e.pdf", b"one", None)[1] == first[1]
    child.stop()
    assert below() <= before


@pytest.mark.parametrize("text", [b"hang", b"stubborn"])
def test_hanging_parser_is_ended(child, text):
    before = below()
    child.ready()
    began = time.monotonic()
    assert child("a.pdf", text, None) == (None, None, "timeout", "the parse exceeded its time budget")
    assert time.monotonic() - began < 1 + 2 * 0.5 + 2
    for _ in range(20):  # its orphans are reaped by whoever has them now
        if below() <= before:
            break
        time.sleep(0.1)
    assert below() <= before
    assert child("b.pdf", b"on", None)[0] == "ON"


def test_dead_parser_costs_its_document(child):
    code, error = child("x/a.pdf", b"exit3", None)[2:]
    assert code == "parse_failed" and error.startswith("the parser exited with code 3 on `a.pdf`: ")
    assert error.endswith("last words") and len(error) < 1000
    assert child("a.pdf", b"killed", None)[3] == "the parser exited with code -9 on `a.pdf`"
    assert child("b.pdf", b"on", None)[0] == "ON"


def test_jobs_go_on_after_a_hang(spark):
    """One task: the documents behind a hanging one are parsed, an archive's budget is its own."""
    texts = ["one", "hang", "two", "exit4", "three", "stubborn", "four"]
    docs = spark.createDataFrame([(f"/d/{i}.pdf", t.encode()) for i, t in enumerate(texts)], "path string, content binary").coalesce(1)
    before = below()
    rows = {r.path: r for r in parse_single(docs, Limits(timeout_secs=1), make_parser()).collect()}
    codes = [rows[f"/d/{i}.pdf"].error_code for i in range(7)]
    assert codes == [None, "timeout", None, "parse_failed", None, "timeout", None]
    assert rows["/d/6.pdf"].result.markdown == "FOUR"
    packs = [("/d/a.zip", zipped(("1.pdf", b"one"), ("2.pdf", b"hang"))), ("/d/b.zip", zipped(("1.pdf", b"one"), ("2.pdf", b"exit5")))]
    out = parse_archives(spark.createDataFrame(packs, "path string, content binary"), Limits(timeout_secs=1), make_parser())
    rows = {r.path: r for r in out.collect()}
    assert rows["/d/a.zip"].error_code == "timeout" and rows["/d/b.zip"].result.markdown == "# 1.pdf\n\nONE"
    time.sleep(0.5)
    assert below() <= before


def test_hangs_do_not_hold_up_the_rest(spark):
    """One task: several documents hang at a time, all others are parsed meanwhile."""
    texts = ["hang" if i % 5 == 2 else f"t{i}" for i in range(40)]
    docs = spark.createDataFrame([(f"/d/{i}.pdf", t.encode()) for i, t in enumerate(texts)], "path string, content binary").coalesce(1)
    before, began = below(), time.monotonic()
    rows = {r.path: r for r in parse_single(docs, Limits(timeout_secs=3), make_parser(), abreast=8).collect()}
    assert time.monotonic() - began < 8 * 3  # one after the other they take as long as that
    for i, text in enumerate(texts):
        row = rows[f"/d/{i}.pdf"]
        assert (row.error_code == "timeout") if text == "hang" else (row.result.markdown == text.upper())
    assert len(rows) == 40
    time.sleep(0.5)
    assert below() <= before
