"""A parser in a process of its own, ended when a document's time is up.

A task starts one child and hands it one document after another.  The child leads a process
group; when a document exceeds its budget, the group and whatever else descends from the
child are asked to stop, then killed after a grace, and the next document gets a new child.
What the parser prints is kept as a tail for its errors.
"""

from __future__ import annotations

import contextlib
import os
import pickle
import selectors
import signal
import struct
import subprocess
import sys
import time

from docloom.limits import KILL_GRACE_SECS, LOG_TAIL_BYTES, LOG_TAIL_CHARS
from docloom.operators.outcomes import PARSE_FAILED, TIMEOUT, TIMEOUT_MESSAGE

START_SECS = 120
CHUNK = 1 << 16

# The child: reads a callable, then documents; writes what the callable gives for each.  It
# dies with its parent, also while the parser hangs.
CHILD = """
import os, pickle, struct, sys
try:
    import ctypes, signal
    ctypes.CDLL(None).prctl(1, signal.SIGKILL)
except Exception:
    pass
asks, answers = sys.stdin.buffer, os.fdopen(int(sys.argv[1]), "wb")
os.set_inheritable(answers.fileno(), False)
def read():
    head = asks.read(8)
    return asks.read(struct.unpack("<Q", head)[0]) if len(head) == 8 else None
def write(value):
    body = pickle.dumps(value)
    answers.write(struct.pack("<Q", len(body)) + body)
    answers.flush()
attempt = pickle.loads(read())
asks_fd = os.dup(0)
os.dup2(os.open(os.devnull, os.O_RDONLY), 0)
asks = os.fdopen(asks_fd, "rb")
write(None)
while (body := read()) is not None:
    write(attempt(*pickle.loads(body)))
"""


def _stat(pid: int) -> tuple[int, int] | None:
    """Parent and start time of a process, where the system tells."""
    with contextlib.suppress(OSError), open(f"/proc/{pid}/stat", "rb") as f:
        fields = f.read().rpartition(b")")[2].split()
        return int(fields[1]), int(fields[19])
    return None


def descendants(pid: int) -> set[tuple[int, int]]:
    """``(pid, start time)`` of the processes below ``pid``, where the system lists them."""
    below: dict[int, list[tuple[int, int]]] = {}
    for name in os.listdir("/proc") if os.path.isdir("/proc/self") else []:
        if name.isdigit() and (stat := _stat(int(name))):
            below.setdefault(stat[0], []).append((int(name), stat[1]))
    out, queue = set(), [pid]
    while queue:
        found = below.get(queue.pop(), [])
        out.update(found)
        queue += [p for p, _ in found]
    return out


class Supervised:
    """Runs ``attempt`` (pickled: name, content, options to an outcome) under a budget a call."""

    def __init__(self, attempt: bytes, budget_secs: float, grace_secs: float = KILL_GRACE_SECS):
        self.attempt, self.budget, self.grace = attempt, budget_secs, grace_secs
        self.child: subprocess.Popen | None = None

    def __call__(self, name: str, content: bytes, options: str | None) -> tuple:
        """The outcome of ``attempt``, or a timeout, or the failure of a child that ended."""
        self.ready()
        deadline = time.monotonic() + self.budget
        try:
            return self._exchange(pickle.dumps((name, content, options)), deadline)
        except TimeoutError:
            self.stop()
            return None, None, TIMEOUT, TIMEOUT_MESSAGE
        except EOFError:
            code = self._ended()
            tail = bytes(self.tail).decode("utf-8", "replace").strip()[-LOG_TAIL_CHARS:]
            base = name.rstrip("/").rpartition("/")[2]
            return None, None, PARSE_FAILED, f"the parser exited with code {code} on `{base}`" + (f": {tail}" if tail else "")

    def ready(self) -> None:
        """Sees to a child; its start is on nobody's budget."""
        if self.child is not None:
            return
        answers, theirs = os.pipe()
        env = {**os.environ, "PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
        self.child = subprocess.Popen(
            [sys.executable, "-c", CHILD, str(theirs)], env=env, pass_fds=(theirs,), start_new_session=True,
            stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.STDOUT,
        )
        os.close(theirs)
        self.answers, self.tail = answers, bytearray()
        for fd in (self.child.stdin.fileno(), self.child.stdout.fileno(), answers):
            os.set_blocking(fd, False)
        try:
            self._exchange(self.attempt, time.monotonic() + START_SECS)
        except (TimeoutError, EOFError):
            said = bytes(self.tail).decode("utf-8", "replace")
            self.stop()
            raise RuntimeError(f"the parser's process did not start: {said[-LOG_TAIL_CHARS:]}") from None

    def _exchange(self, ask: bytes, deadline: float) -> object:
        """Sends and receives one message while the child's prints are drained."""
        asks, said = self.child.stdin.fileno(), self.child.stdout.fileno()
        left, answer = memoryview(struct.pack("<Q", len(ask)) + ask), bytearray()
        del self.tail[:]
        with selectors.DefaultSelector() as ready:
            ready.register(asks, selectors.EVENT_WRITE)
            ready.register(self.answers, selectors.EVENT_READ)
            ready.register(said, selectors.EVENT_READ)
            while True:
                wait = deadline - time.monotonic()
                if wait <= 0:
                    raise TimeoutError
                for key, _ in ready.select(wait):
                    if key.fd == asks:
                        try:
                            left = left[os.write(asks, left[:CHUNK]) :]
                        except BrokenPipeError:
                            left = left[:0]
                        if not left:
                            ready.unregister(asks)
                    elif key.fd == said:
                        text = os.read(said, CHUNK)
                        if not text:
                            ready.unregister(said)
                        self.tail = (self.tail + text)[-LOG_TAIL_BYTES:]
                    else:
                        part = os.read(self.answers, CHUNK)
                        if not part:
                            self._drain(said)
                            raise EOFError
                        answer += part
                        if len(answer) >= 8 and len(answer) - 8 == struct.unpack_from("<Q", answer)[0]:
                            return pickle.loads(memoryview(answer)[8:])

    def _drain(self, said: int) -> None:
        with contextlib.suppress(BlockingIOError):
            while text := os.read(said, CHUNK):
                self.tail = (self.tail + text)[-LOG_TAIL_BYTES:]

    def _ended(self) -> int:
        """The code of a child that closed its answers; one that still runs is stopped."""
        child = self.child
        with contextlib.suppress(subprocess.TimeoutExpired):
            child.wait(self.grace)
        self.stop()
        return child.returncode

    def stop(self) -> None:
        """Ends the child and all it has started; nothing of it is left afterwards."""
        child, self.child = self.child, None
        if child is None:
            return
        rest = descendants(child.pid)
        self._signal(child.pid, rest, signal.SIGTERM)
        with contextlib.suppress(subprocess.TimeoutExpired):
            child.wait(self.grace)
        # The group outlives its leader while a member ignores the first signal.
        self._signal(child.pid, rest | descendants(child.pid), signal.SIGKILL)
        with contextlib.suppress(subprocess.TimeoutExpired):
            child.wait(self.grace)
        for stream in (child.stdin, child.stdout):
            with contextlib.suppress(OSError):
                stream.close()
        os.close(self.answers)

    @staticmethod
    def _signal(leader: int, rest: set[tuple[int, int]], what: int) -> None:
        with contextlib.suppress(ProcessLookupError, PermissionError):
            os.killpg(leader, what)
        for pid, started in rest:
            if (stat := _stat(pid)) and stat[1] == started:  # not a newer process of that number
                with contextlib.suppress(ProcessLookupError, PermissionError):
                    os.kill(pid, what)
