"""Benchmark decontamination over a distributed positional inverted index.

Only terms that some benchmark window needs are indexed: two more of a window's rarest terms
than it may lack words decide where it can stand.  Two of them must stand there about as far
apart as in the window, so postings keep positions with such a partner only.  The postings,
shifted by the terms' offsets in the item, are intersected; where two fall on one diagonal or
up to two words apart, the whole window is compared word by word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import (
    alnum_words,
    in_sieve,
    mix64,
    sieve,
    sieve_bits,
    staged,
    text_mark,
    text_or_empty,
    without,
    word_hashes,
)

WINDOW = 10
NEAR = 8
SHIFT = 2
SLICE_WORDS = 400_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _words(value, member: np.ndarray) -> np.ndarray:
    return word_hashes(value.as_py().encode("utf-8", "surrogatepass"), member).view(np.int64)


def _together(texts):
    """The sizes of some texts in words and their words behind each other, slice by slice."""
    member = alnum_words()
    parts, size = [], 0
    for value in texts:
        parts.append(_words(value, member))
        size += parts[-1].size
        if size >= SLICE_WORDS:
            yield np.array([p.size for p in parts]), np.concatenate(parts)
            parts, size = [], 0
    if parts:
        yield np.array([p.size for p in parts]), np.concatenate(parts)


def pair_keys(first: np.ndarray, second: np.ndarray, apart) -> np.ndarray:
    """A hash of two terms and how many words the second stands after the first."""
    with np.errstate(over="ignore"):
        x = first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.view(np.uint64)
        return mix64(x * np.uint64(0xD6E8FEB86659FD93) + np.asarray(apart, np.uint64)).view(np.int64)


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item_id, imark, terms``: the word hashes of each item, in order."""

    def run(batches):
        member = alnum_words()
        for b in batches:
            terms = [_words(t, member) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(terms, pa.list_(pa.int64()))],
                ["item_id", "imark", "terms"],
            )

    items = benchmark.filter("item_id is not null and text is not null").select(
        "item_id", text_mark().alias("imark"), "text"
    )
    return items.distinct().mapInArrow(run, "item_id long, imark long, terms array<long>").filter(
        F.size("terms") > 0
    )


def term_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """How often each term that passes the sieve occurs in the whole corpus."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for b in batches:
            for _, words in _together(b.column(0)):
                words = words[in_sieve(held.value, words)]
                terms, n = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n)], ["term", "n"])

    found = docs.select(text_or_empty().alias("text")).mapInArrow(run, "term long, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``item_id, imark, offset, term, pairs, alone``: the rarest terms of the windows.

    A near window lacks up to ``free`` words.  Terms that the corpus lacks are among them; of
    the others the ``free + 2`` rarest are taken, two of which must stand.  ``pairs`` are the keys
    of this term and each later one of a window at every distance the shift allows; ``alone``
    marks a term that is enough by itself.
    """
    spread = items.select("item_id", "imark", F.posexplode("terms").alias("offset", "term"))
    rated = spread.join(counts, "term", "left").groupBy("item_id", "imark").agg(
        F.sort_array(F.collect_list(F.struct("offset", "term", F.coalesce("n", F.lit(0)).alias("n")))).alias("w")
    )

    def run(frames):
        for f in frames:
            rows = []
            for item, mark, words in zip(f["item_id"], f["imark"], f["w"]):
                n = np.array([w["n"] for w in words])
                size = min(WINDOW, len(n))
                windows = set()
                for start in range(len(n) - size + 1):
                    here = n[start : start + size]
                    free = size - -(-size * NEAR // WINDOW) - int((here == 0).sum())
                    if free >= 0:
                        order = [k for k in np.argsort(here, kind="stable") if here[k] > 0][: free + 2]
                        if len(order) > free:
                            windows.add((tuple(sorted(int(k) + start for k in order)), len(order) - free))
                terms = np.array([w["term"] for w in words], np.int64)
                alone = {o for w, need in windows if need < 2 for o in w}
                after: dict[int, set] = {}
                for w, _ in windows:
                    for i, o in enumerate(w):
                        after.setdefault(o, set()).update((later, later - o) for later in w[i + 1 :])
                for offset in sorted(after):
                    pairs = {(k, far + s) for k, far in after[offset] for s in range(-SHIFT, SHIFT + 1) if far + s > 0}
                    later, far = (np.array(x, np.int64) for x in zip(*sorted(pairs))) if pairs else (np.zeros(0, np.int64),) * 2
                    keys = pair_keys(np.full(later.size, terms[offset]), terms[later], far)
                    rows.append((item, mark, offset, int(terms[offset]), keys.tolist(), offset in alone))
            yield pd.DataFrame(rows, columns=["item_id", "imark", "offset", "term", "pairs", "alone"])

    return rated.mapInPandas(
        run,
        "item_id long, imark long, offset int, term long, pairs array<long>, alone boolean",
    )


def partnered(words: np.ndarray, wanted: np.ndarray, pairs: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Positions of wanted terms that are enough alone or have a partner at a fitting distance.

    In texts behind each other a partner may stand in the next one, which only keeps more.
    """
    here = in_sieve(wanted, words)
    keep = np.zeros(words.size, bool)
    at = np.flatnonzero(here)
    keep[at] = in_sieve(alone, words[at])
    for apart in range(1, WINDOW + SHIFT):
        first = at[: np.searchsorted(at, words.size - apart)]
        first = first[here[first + apart]]
        first = first[in_sieve(pairs, pair_keys(words[first], words[first + apart], apart))]
        keep[first] = keep[first + apart] = True
    return np.flatnonzero(keep)


def postings(docs: DataFrame, anchor: DataFrame) -> DataFrame:
    """The index: ``term, doc_id, mark, positions, n_words``; a row without term per document."""
    pairs = anchor.select(F.explode("pairs").alias("pair"))
    held = docs.sparkSession.sparkContext.broadcast(
        (
            sieve(F.col("term"), anchor),
            sieve(F.col("pair"), pairs, sieve_bits(pairs.count())),
            sieve(F.col("term"), anchor.filter("alone")),
        )
    )

    def run(batches):
        for b in batches:
            done = 0
            for sizes, words in _together(b.column(2)):
                own = b.slice(done, len(sizes))
                done += len(sizes)
                starts = np.cumsum(sizes) - sizes
                at = partnered(words, *held.value)
                doc = np.searchsorted(starts, at, "right") - 1
                order = np.lexsort((words[at], doc))
                at, doc = at[order], doc[order]
                term, place = words[at], (at - starts[doc]).astype(np.int32)
                first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])]) if at.size else at
                index = own.take(pa.array(doc[first])).select([0, 1])
                none = pa.nulls(first.size, pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.r_[first, at.size], pa.int32()), pa.array(place))
                names = ["term", "doc_id", "mark", "positions", "n_words"]
                yield pa.RecordBatch.from_arrays([pa.array(term[first]), *index.columns, lists, none], names)
                gone, lists = pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([gone, own.column(0), own.column(1), lists, pa.array(sizes)], names)

    return docs.select("doc_id", text_mark().alias("mark"), text_or_empty().alias("text")).mapInArrow(
        run, "term long, doc_id long, mark long, positions array<int>, n_words long"
    )


def intersect(index: DataFrame, anchor: DataFrame) -> DataFrame:
    """``doc_id, mark, item_id, imark, diagonal``: where terms of an item stand right to each other.

    These are the diagonals from which on, within the shift, two terms of the item stand, or
    one that is enough alone.  Each hit counts for its own diagonal and for those before it
    that the shift reaches, so no group gathers its hits.
    """
    at = F.col("at") - F.col("offset")
    shifts = F.explode(F.array(*[F.lit(s) for s in range(SHIFT + 1)]))
    hits = (
        index.filter("term is not null")
        .select("term", "doc_id", "mark", "positions")
        .distinct()
        .join(anchor.select("term", "item_id", "imark", "offset", "alone"), "term")
        .select("doc_id", "mark", "item_id", "imark", "offset", "alone", F.explode("positions").alias("at"))
        .select("doc_id", "mark", "item_id", "imark", "offset", "alone", at.alias("at"), shifts.alias("shift"))
    )
    met = hits.groupBy("doc_id", "mark", "item_id", "imark", (F.col("at") - F.col("shift")).alias("diagonal")).agg(
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
        F.max(F.col("shift") == 0).alias("own"),
        F.max("alone").alias("alone"),
    )
    return met.filter("own and (alone or first < last)").select("doc_id", "mark", "item_id", "imark", "diagonal")


def may_stand(words: np.ndarray, terms: np.ndarray, diagonal: int) -> bool:
    """Whether 8 of 10 words of some window stand on diagonals up to the shift away, in any order."""
    size = min(WINDOW, terms.size)
    at = np.arange(diagonal - SHIFT, diagonal + SHIFT + 1)[:, None] + np.arange(terms.size)
    np.clip(at, 0, words.size - 1, out=at)  # beyond the ends more may match, none less
    sums = np.concatenate([[0], np.cumsum((words[at] == terms).any(axis=0))])
    return bool(((sums[size:] - sums[:-size]) * WINDOW >= size * NEAR).any())


def stands_nearly(words: np.ndarray, terms: np.ndarray, diagonal: int) -> bool:
    """Whether 8 of 10 words of a window stand in order, on diagonals at most the shift apart.

    The bands of diagonals that hold the given one are tried: longest common subsequences of
    all windows at once.
    """
    size, wide = min(WINDOW, terms.size), SHIFT + 1
    low = np.arange(diagonal - SHIFT, diagonal + 1)
    at = low[:, None, None] + np.arange(terms.size)[None, :, None] + np.arange(wide)
    inside = (at >= 0) & (at < words.size)
    same = inside & (words[np.where(inside, at, 0)] == terms[None, :, None])
    starts = terms.size - size + 1
    best = np.zeros((wide, starts, wide), np.int64)
    for i in range(size):
        here = best + same[:, i : i + starts]
        here[:, :, :-1] = np.maximum(here[:, :, :-1], best[:, :, 1:])
        here[:, :, -1] = np.maximum(here[:, :, -1], best[:, :, -1])
        best = np.maximum.accumulate(here, axis=2)
    return bool((best[:, :, -1] * WINDOW >= size * NEAR).any())


def compare(words: np.ndarray, terms: np.ndarray, diagonal: int, hit: np.ndarray) -> tuple[bool, bool]:
    """Marks the words inside windows that stand on the diagonal; whether any does, exactly or nearly."""
    if not words.size or not may_stand(words, terms, diagonal):
        return False, False
    size = min(WINDOW, terms.size)
    low, high = max(0, -diagonal), min(terms.size, words.size - diagonal)
    exact = False
    if high - low >= size:
        same = words[diagonal + low : diagonal + high] == terms[low:high]
        sums = np.concatenate([[0], np.cumsum(same)])
        matched = sums[size:] - sums[:-size]
        for start in np.flatnonzero(matched == size):
            hit[diagonal + low + start : diagonal + low + start + size] = True
        exact = bool((matched == size).any())
    return exact, exact or stands_nearly(words, terms, diagonal)


def _verify(batches):
    member = alnum_words()
    for b in batches:
        rows = []
        for doc, mark, text, found in zip(*[b.column(i) for i in range(4)]):
            words = _words(text, member)
            hit = np.zeros(words.size, bool)
            items, near = set(), set()
            for c in found.as_py():
                item, terms = str(c["item_id"]), np.array(c["terms"], np.int64)
                if terms.size == 1:
                    same = words == terms[0]
                    hit |= same
                    if same.any():
                        items.add(item)
                    continue
                for diagonal in c["diagonals"]:
                    exact, close = compare(words, terms, diagonal, hit)
                    if exact:
                        items.add(item)
                    if close:
                        near.add(item)
            listed = ",".join(sorted(items))
            rows.append(
                (doc.as_py(), mark.as_py(), int(hit.sum()), len(items), hashlib.sha256(listed.encode()).hexdigest(), len(near - items))
            )
        cols = list(zip(*rows)) or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types)],
            ["_id", "_mark", "n_hit", "n_items", "items_sha256", "n_near"],
        )


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row, and ``mark, n_near``.

    ``n_near`` counts items without an exact window of which at least 8 of 10 words of some
    window stand in order, shifted against each other by two words at most.  A null text has no words.  Items without id
    or words ask for nothing; rows of one item id count as one item with all their windows.
    Document rows are told apart by id and text, so repeated rows get equal results; a null
    id keeps its row; further columns are ignored.
    """
    items = staged(item_words(benchmark), "bench-items")
    terms = items.select(F.explode("terms").alias("term"))
    counts = staged(term_counts(docs, sieve(F.col("term"), terms)), "bench-terms")
    anchor = staged(anchors(items, counts), "bench-anchors")
    index = staged(postings(docs, anchor), "bench-postings")
    found = staged(intersect(index, anchor), "bench-diagonals")
    lists = (
        found.groupBy("doc_id", "mark", "item_id", "imark")
        .agg(F.collect_list("diagonal").alias("diagonals"))
        .join(items, ["item_id", "imark"])
        .groupBy("doc_id", "mark")
        .agg(F.collect_list(F.struct("item_id", "diagonals", "terms")).alias("found"))
        .withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    )
    held = docs.sparkSession.sparkContext.broadcast(sieve(F.xxhash64("doc_id"), found))

    def some(batches):
        for b in batches:
            keep = in_sieve(held.value, b.column(3).to_numpy(zero_copy_only=False))
            yield b.filter(pa.array(keep)).select([0, 1, 2])

    texts = docs.select("doc_id", text_mark().alias("mark"), text_or_empty().alias("text"), F.xxhash64("doc_id").alias("h"))
    texts = texts.mapInArrow(some, "doc_id long, mark long, text string")
    meet = texts["doc_id"].eqNullSafe(lists["_id"]) & (texts["mark"] == lists["_mark"])
    verified = (
        texts.join(lists, meet)
        .select("doc_id", "mark", "text", "found")
        .mapInArrow(_verify, "_id long, _mark long, n_hit long, n_items long, items_sha256 string, n_near long")
        .dropDuplicates(["_id", "_mark"])
    )
    rows = index.filter("term is null").select("doc_id", "mark", "n_words")
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = rows.join(verified, rows["doc_id"].eqNullSafe(verified["_id"]) & (rows["mark"] == verified["_mark"]), "left")
    return joined.select(
        "doc_id",
        "n_words",
        n("n_hit"),
        n("n_items"),
        F.coalesce("items_sha256", F.lit(EMPTY_SHA)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "mark",
        n("n_near"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window, all columns kept."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    return without(docs, found.filter("contaminated").select("doc_id", "mark"))
