"""Periodic runs of words, found from multi-scale minimizers.

A run repeats a root of ``q`` words four times or more.  At the scale ``k`` with
``k/2 < q <= k`` the stretches of ``k`` words inside a run are equal exactly at distances that
are multiples of ``q``, and any ``k/2`` of them in a row are different.  So the minima of
windows of ``k/2`` stretches recur at distance ``q`` all along the run: neighbours among the
positions of equal minimizers, ``k/2`` to ``k`` words apart, seed every run of the scale.  A
seed is extended both ways by comparing words at its distance.  Periods up to ``SHORT`` are
too short for windows and are scanned lag by lag.

Documents of a batch lie behind each other, a word of its own between two, so that every step
but the extension runs over all of them at once; a scale keeps only documents long enough.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import mix64, text_or_empty

SHORT = 8
LEAST = 6
TIMES = 4
SLICE_WORDS = 400_000
FIELDS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def _least(period: int) -> int:
    return max(LEAST, TIMES * period)


def _factors(n: int) -> list[int]:
    """The prime factors of ``n``."""
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] if n > 1 else out


def _sliding(values: np.ndarray, width: int, ufunc: np.ufunc, fill) -> np.ndarray:
    """``ufunc`` over each ``width`` values in a row; the last ``width - 1`` places see fewer."""
    n = values.size
    rows = -(-(n + width) // width)
    grid = np.full(rows * width, fill, values.dtype)
    grid[:n] = values
    grid = grid.reshape(rows, width)
    ahead = ufunc.accumulate(grid, axis=1).ravel()
    behind = ufunc.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(behind[:n], ahead[width - 1 : width - 1 + n])


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least hash of some ``width`` in a row; equal least ones all count."""
    if width == 1:
        return np.arange(hashes.size)
    low = _sliding(hashes, width, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
    # The greatest minimum of the windows that hold a position, those from `width - 1` before on.
    best = _sliding(low[::-1], width, np.maximum, np.uint64(0))[::-1]
    return np.flatnonzero(best == hashes)


def _seeds(hashes: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(position, period)`` of neighbouring equal minimizers, ``k/2`` to ``k`` words apart."""
    at = minimizers(hashes, k // 2)
    h = hashes[at]
    order = np.argsort(h, kind="stable")
    at, h = at[order], h[order]
    apart = at[1:] - at[:-1]
    near = np.flatnonzero((h[1:] == h[:-1]) & (apart > k // 2) & (apart <= k))
    return places[at[near]], apart[near]


def _reach(words: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The widest ``[a, b)`` inside ``[low, high)`` around ``at`` whose words recur ``lag`` words on."""
    b, step = at, 64
    while b < high - lag:
        end = min(b + step, high - lag)
        miss = np.flatnonzero(words[b:end] != words[b + lag : end + lag])
        if miss.size:
            b += int(miss[0])
            break
        b, step = end, step * 2
    a, step = at, 64
    while a > low:
        begin = max(a - step, low)
        miss = np.flatnonzero(words[begin:a] != words[begin + lag : a + lag])
        if miss.size:
            a = begin + int(miss[-1]) + 1
            break
        a, step = begin, step * 2
    return a, b


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether the root at ``start`` is no repetition itself, so that ``period`` is the smallest."""
    root = words[start : start + period]
    return not any((root[: period - period // f] == root[period // f :]).all() for f in _factors(period))


def _short_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of periods up to ``SHORT``: direct scans, one lag after another."""
    out, equal = [], {}
    for lag in range(1, min(SHORT, words.size // TIMES) + 1):
        same = np.zeros(words.size - lag + 2, np.int8)
        same[1:-1] = words[:-lag] == words[lag:]
        edges = np.flatnonzero(np.diff(same))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts + lag >= _least(lag)
        starts, ends = starts[long], ends[long]
        for f in _factors(lag):
            # The root repeats after lag/f words when as many words of it as can do recur there.
            sums = equal[lag // f]
            whole = sums[starts + lag - lag // f] - sums[starts] == lag - lag // f
            starts, ends = starts[~whole], ends[~whole]
        equal[lag] = np.concatenate([[0], np.cumsum(same[1:-1], dtype=np.int64)])
        out += zip(starts.tolist(), (ends - starts + lag).tolist(), [lag] * starts.size)
    return out


def _long_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of periods over ``SHORT``, scale by scale."""
    out: list[tuple[int, int, int]] = []
    ends = starts + sizes
    with np.errstate(over="ignore"):
        k = 1
        places, hashes, of = np.arange(words.size), mix64(words.astype(np.uint64) + np.uint64(1)), None
        while True:
            # The next scale's stretches are two of this one's, `k` words apart.
            later = np.zeros_like(hashes)
            later[: max(hashes.size - k, 0)] = hashes[k:]
            hashes = mix64(hashes * np.uint64(0x9E3779B97F4A7C15) + later)
            k *= 2
            if k <= SHORT:
                continue
            long = sizes >= TIMES * (k // 2 + 1)
            if not long.any():
                return out
            if of is None or not long[of].all():
                of = np.searchsorted(starts, places, "right") - 1
                keep = long[of]
                places, hashes, of = places[keep], hashes[keep], of[keep]
            at, periods = _seeds(hashes, places, k)
            done: dict[int, int] = {}
            for i, q in sorted(zip(at.tolist(), periods.tolist())):
                if i < done.get(q, -1):
                    continue
                d = int(np.searchsorted(starts, i, "right")) - 1
                a, b = _reach(words, i, q, int(starts[d]), int(ends[d]))
                done[q] = max(b, i + 1)
                if b - a + q >= _least(q) and _primitive(words, a, q):
                    out.append((a, b - a + q, q))


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Every run ``(start, length, period)`` of each sequence of word numbers, by start, then period."""
    sizes = np.array([t.size for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int64)
    words = np.zeros(int(sizes.sum()) + sizes.size, np.int64)
    for i, t in enumerate(texts):
        words[starts[i] : starts[i] + t.size] = t
    words[starts + sizes] = -1 - np.arange(sizes.size)  # a word of its own behind each
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, length, q in sorted({*_short_runs(words), *_long_runs(words, starts, sizes)}, key=lambda x: (x[0], x[2])):
        d = int(np.searchsorted(starts, a, "right")) - 1
        out[d].append((a - int(starts[d]), length, q))
    return out


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most repeats; ties go to the smaller start, then period."""

    def order(x, y):
        more = y[1] * x[2] - x[1] * y[2]
        return more or x[0] - y[0] or x[2] - y[2]

    return min(runs, key=cmp_to_key(order)) if runs else None


def dropped(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Marks the words that stand in some run after its first root."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] > 0


def planted(words: list, doc_id: int | None) -> list:
    """The contract's rewriting: documents whose hash divides by ten end in a repeated stretch."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def periodic_runs(docs: DataFrame, plant: bool = False, outputs: bool = True) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: its runs, the best one and the collapsed text.

    Words end at ASCII white space.  ``runs`` lists every run by start, then period;
    ``collapsed`` joins the words that stand in no run after its first root by one blank; the
    two digests are those of ``start,length,period`` lines and of ``collapsed``.  Without
    ``outputs`` these two columns are left out.  ``plant`` first applies the contract's
    rewriting by the hash of the id.

    A null or blank text has no words and no runs, four nulls and the digests of nothing.  A
    null id keeps its row, unrewritten; repeated rows give equal rows; ties of the best run go
    to the smaller start, then period; further columns are ignored; an empty table gives no
    rows.  Texts of any length are searched whole, in time that grows with n log n and memory
    that grows with the words of the longest text or of ``SLICE_WORDS``.
    """
    fields = FIELDS if outputs else FIELDS[: FIELDS.index(", runs array")]

    def flush(ids, texts):
        lists = find_runs([_numbered(t) for t in texts])
        cols: list[list] = [[] for _ in range(10)]
        for doc, words, runs in zip(ids, texts, lists):
            best = best_run(runs)
            if runs:
                gone = dropped(runs, len(words))
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            text = b" ".join(words)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            start, length, period = best or (None, None, None)
            row = (
                doc, len(runs), start, length, period, best and 1000 * length // period,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(),
            )
            for c, v in zip(cols, row):
                c.append(v)
            if outputs:
                cols[8].append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                cols[9].append(text.decode("utf-8", "surrogatepass"))
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        types = [*[pa.int64()] * 6, pa.string(), pa.string(), *([pa.list_(run), pa.string()] if outputs else [])]
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[: len(types)])

    def run(batches):
        for b in batches:
            ids, texts, size = [], [], 0
            for doc, value in zip(b.column(0).to_pylist(), b.column(1)):
                words = value.as_buffer().to_pybytes().split()
                if texts and size + len(words) > SLICE_WORDS:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(planted(words, doc) if plant else words)
                size += len(words)
            if texts:
                yield flush(ids, texts)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, fields)
