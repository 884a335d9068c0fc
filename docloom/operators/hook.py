"""The pluggable parser: one callable, run on every document that passed."""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from docloom.limits import KILL_GRACE_SECS
from docloom.operators.outcomes import PARSE_FAILED, TIMEOUT, TIMEOUT_MESSAGE
from docloom.operators.supervise import Supervised

Parser = Callable[[str, bytes, dict], tuple[str, int | None]]

PATIENCE_SECS = 0.2
FLUSH_CHARS = 16 * 1024 * 1024
PARSED_FIELDS = "markdown string, page_count bigint, error_code string, error string, elapsed_ms bigint"


class ParseFailure(Exception):
    """Raised by a parser to give its failure a code of its own.

    Any exception with a text ``code`` does the same.
    """

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def decode_text(name: str, content: bytes, options: dict) -> tuple[str, int | None]:
    """Default parser: the bytes are the markdown.  Needs no models."""
    return content.decode("utf-8", errors="replace"), None


def _attempt(parser: Parser, name: str, content: bytes, options: str | None) -> tuple:
    try:
        markdown, pages = parser(name, content, json.loads(options) if options else {})
        return markdown, pages, None, None
    except TimeoutError:
        return None, None, TIMEOUT, TIMEOUT_MESSAGE
    except Exception as exc:  # one bad document must not fail the job
        code = getattr(exc, "code", None)
        if isinstance(code, str):
            return None, None, code, str(exc)
        return None, None, PARSE_FAILED, f"{type(exc).__name__}: {exc}"


def _clocked(one: Callable, row: dict) -> tuple:
    """A document's row, its outcome and the milliseconds it took."""
    if row["error_code"] is not None:
        return row, (None, None, row["error_code"], row["error"]), 0
    if isinstance(one, Supervised):
        one.ready()
    began = time.monotonic()
    parsed = one(row["name"], row["content"], row["options"])
    return row, parsed, int(1000 * (time.monotonic() - began))


def _abreast(rows: Iterator[dict], children: list[Supervised], patience: float) -> Iterator[tuple]:
    """What ``_clocked`` gives for each row; one that keeps its child long does not hold up the rest.

    Documents go one by one to the same child.  When one takes longer than ``patience``, the
    next goes to another child, which only then is started, as long as there is one.
    """
    free, slow, pending = list(children), set(), {}
    with ThreadPoolExecutor(len(children)) as pool:
        try:
            for row in rows:
                while pending and (not free or pending.keys() - slow):
                    done, rest = wait(pending, patience if free else None, FIRST_COMPLETED)
                    for call in done:
                        free.append(pending.pop(call))
                        yield call.result()
                    slow = set(rest) if not done else slow & rest
                child = free.pop()
                pending[pool.submit(_clocked, child, row)] = child
            while pending:
                for call in wait(pending, None, FIRST_COMPLETED).done:
                    del pending[call]
                    yield call.result()
        finally:
            wait(pending)
            # In a thread of the pool, as a child dies with the thread that has started it.
            list(pool.map(Supervised.stop, children))


def parse_documents(
    docs: DataFrame, keep: list[str], parser: Parser = decode_text,
    timeout_secs: float | None = None, grace_secs: float = KILL_GRACE_SECS, abreast: int = 1,
) -> DataFrame:
    """Adds ``markdown, page_count``, the outcome and ``elapsed_ms`` to each document.

    ``docs`` has the ``keep`` columns and ``name, content, options, error_code,
    error``.  Rows that already carry an error skip the parser; hand them in with
    null content, as no filter is pushed through a Python stage.

    With ``timeout_secs`` the parser runs in a child of the task, which is ended with all it
    has started when a document takes longer, or ``grace_secs`` after that; its death costs that document only.
    The built-in decoder needs no child.  With ``abreast`` of more than one, a task has so many
    children at most, started only while others keep their document long: for parsers that may
    wait or hang, and have room (cores, memory, models) for so many in each task.
    """
    attempt = functools.partial(_attempt, parser)
    hard = timeout_secs is not None and parser is not decode_text
    packed = cloudpickle.dumps(attempt) if hard else b""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep]
    ordered = [f.name for f in docs.schema if f.name in keep]
    columns = [*ordered, "markdown", "page_count", "error_code", "error", "elapsed_ms"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=columns)
        made["page_count"] = made["page_count"].astype("Int64")
        return made

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not hard:
            yield from parsed_frames(batches, attempt)
            return
        children = [Supervised(packed, timeout_secs, grace_secs) for _ in range(abreast)]
        if abreast > 1:
            rows = (row for batch in batches for row in batch.to_dict("records"))
            yield from framed(_abreast(rows, children, PATIENCE_SECS))
            return
        try:
            yield from parsed_frames(batches, children[0])
        finally:
            children[0].stop()

    def parsed_frames(batches: Iterator[pd.DataFrame], one: Callable) -> Iterator[pd.DataFrame]:
        yield from framed(_clocked(one, row) for batch in batches for row in batch.to_dict("records"))

    def framed(outcomes: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for row, parsed, spent in outcomes:
            rows.append((*[row[c] for c in ordered], *parsed, spent))
            held += len(parsed[0] or "")
            if held >= FLUSH_CHARS or len(rows) >= 1000:
                yield frame(rows)
                rows, held = [], 0
        if rows:
            yield frame(rows)

    needed = [*ordered, *[c for c in ("name", "content", "options", "error_code", "error") if c not in keep]]
    return docs.select(*needed).mapInPandas(run, schema=", ".join([*fields, PARSED_FIELDS]))
