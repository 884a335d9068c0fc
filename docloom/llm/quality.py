"""Quality classifier: document scores learnt from preference pairs (Bradley-Terry)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import held_out, space_words, staged, text_or_empty, word_hashes

FEATURES = 44
BUCKET = 256
PARTNERS = 32
PIECE = 2048
RIDGE = 1e-3
STEPS = 50
TOLERANCE = 1e-8
SPREAD = 8.0


def features_of(data: bytes, member: np.ndarray) -> np.ndarray:
    """Shape of a text: byte classes, words, repeats and lines, each within about 0..1."""
    out = np.zeros(FEATURES)
    a = np.frombuffer(data, np.uint8)
    if not a.size:
        return out
    counts = np.bincount(a, minlength=256).astype(float)
    words = word_hashes(data, member)
    n = max(words.size, 1)
    marks = counts[33:48].tolist() + counts[58:65].tolist() + counts[91:97].tolist()
    marks += counts[123:127].tolist()  # 32 ASCII marks
    out[:32] = np.minimum(np.array(marks) / n, 2.0)
    letters = counts[65:91].sum() + counts[97:123].sum()
    out[32] = counts[65:91].sum() / max(letters, 1)
    out[33] = counts[48:58].sum() / a.size
    out[34] = counts[128:].sum() / a.size
    out[35] = min(a.size / n / 20, 2.0)
    out[36] = min(np.log1p(words.size) / 10, 2.0)
    if words.size:
        out[37] = (words[1:] == words[:-1]).sum() / n
        # How much the vocabulary falls short of its usual growth, in blocks of 64 words.
        block = words[: 64 * (words.size // 64)].reshape(-1, 64) if words.size >= 64 else words[None]
        ordered = np.sort(block, axis=1)
        same = (ordered[:, 1:] == ordered[:, :-1]).mean(axis=1) if ordered.shape[1] > 1 else np.zeros(1)
        out[38], out[39] = same.mean(), same.max()
    lines = data.split(b"\n")
    out[40] = 1 - len(set(lines)) / len(lines)
    out[41] = min(len(lines) / n, 2.0)
    out[42] = sum(map(len, set(lines))) / max(sum(map(len, lines)), 1)
    out[43] = sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines) / len(lines)
    return out


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id``, the features, and the row's text mark, one row per document row."""

    def run(batches):
        member = space_words()
        for batch in batches:
            texts = batch.column(1)
            rows = [features_of(t.as_py().encode("utf-8", "surrogatepass"), member) for t in texts]
            flat = np.array(rows, np.float32).reshape(-1)
            ends = np.arange(0, flat.size + 1, FEATURES, dtype=np.int32)
            values = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "features"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, features array<float>"
    )


def expand(x: np.ndarray) -> np.ndarray:
    """Adds square roots, which open up the low end of the ratios."""
    x = np.asarray(x, float)
    return np.hstack([x, np.sqrt(np.maximum(x, 0))])


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((expand(x) - mean) / scale, -6, 6)


def buckets(known: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """``features, quality, bucket, copy``: the rows of both labels dealt out, so that each meets the other label.

    A bucket has about ``BUCKET`` rows of the commoner label and at least some ``PARTNERS`` of
    the rarer, whose rows come in several buckets if there are too few; ``copy`` counts them.
    """
    n = max(1, -(-max(n_good, n_bad) // BUCKET))
    copies = min(n, max(1, -(-PARTNERS * n // max(1, min(n_good, n_bad)))))
    times = F.when(F.col("quality") == int(n_good <= n_bad), F.lit(copies)).otherwise(F.lit(1))
    dealt = known.select(
        "features", "quality", F.xxhash64("doc_id", "features").alias("_home"),
        F.explode(F.sequence(F.lit(0), times - 1)).alias("copy"),
    )
    bucket = F.pmod(F.pmod("_home", F.lit(n)) + F.col("copy") * (n // copies), F.lit(n))
    dealt = dealt.select("features", "quality", bucket.cast("long").alias("bucket"), "copy")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "copy", "quality", "features")


def _arrays(t: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The features, a row each, and which rows are good."""
    flat = pa.chunked_array(t.column("features")).combine_chunks().flatten() if t.num_rows else np.zeros(0)
    return np.asarray(flat, float).reshape(-1, FEATURES), np.asarray(t.column("quality")) == 1


def _by_bucket(batches):
    """Tables of a bucket each, from batches sorted by it."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        bucket = np.asarray(t.column("bucket"))
        start = 0
        for cut in (np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist():
            yield t.slice(start, cut - start)
            start = cut
        held = t.slice(start)
    if held is not None and held.num_rows:
        yield held


def _summed(train: DataFrame, sums) -> np.ndarray:
    """The vector that ``sums(features, good)`` gives for a bucket, added up over all of them."""

    def run(batches):
        total = sum(sums(*_arrays(t)) for t in _by_bucket(batches))
        if np.ndim(total):
            at = pa.array(np.arange(total.size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(total)], ["i", "v"])

    # Sorted before they are added, as tasks end in any order.
    whole = F.aggregate(F.array_sort(F.collect_list("v")), F.lit(0.0), lambda a, v: a + v)
    parts = train.mapInArrow(run, "i int, v double").groupBy("i").agg(whole.alias("v"))
    return np.array([r.v for r in sorted(parts.collect())])


def pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, loss, gradient and curvature of the logistic loss, over all pairs of two sets, in one vector."""
    margin = (good @ w)[:, None] - bad @ w
    p = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
    h = p * (1 - p)
    cross = good.T @ h @ bad
    curve = (good.T * h.sum(axis=1)) @ good + (bad.T * h.sum(axis=0)) @ bad - cross - cross.T
    grad = p.sum(axis=0) @ bad - p.sum(axis=1) @ good
    return np.concatenate([[p.size, np.logaddexp(0, -margin).sum()], grad, curve.ravel()])


def fit_pairs(train: DataFrame, n_good: int, n_bad: int):
    """Weights by logistic loss on the feature differences of (better, worse) pairs.

    ``train`` comes from ``buckets``: every row takes part, in all pairs of its bucket.  Steps
    are Newton's, their sums made by the tasks, until the loss stands still.
    Returns ``(mean, scale, weights, cut, width)``: the cut is the quantile of the
    training scores at the share of worse documents, the width their spread.
    With no pair to learn from every score is one half.
    """
    size = 2 * FEATURES
    if not n_good or not n_bad:
        return np.zeros(size), np.ones(size), np.zeros(size), 0.0, 1.0
    rows = train.filter("copy = 0")

    def moments(x, good):
        z = expand(x)
        return np.concatenate([z.sum(axis=0), (z**2).sum(axis=0)])

    mean, square = _summed(rows, moments).reshape(2, size) / (n_good + n_bad)
    scale = np.sqrt(np.maximum(square - mean**2, 0)) + 1e-3

    def at(w: np.ndarray):
        def sums(x, good):
            z = _standard(x, mean, scale)
            better, worse = z[good], z[~good]
            total = np.zeros(2 + size + size * size)
            # Equal rows share a bucket, however many: pieces bound the pairs in hand.
            for i in range(0, len(better), PIECE):
                for j in range(0, len(worse), PIECE):
                    total += pair_sums(better[i : i + PIECE], worse[j : j + PIECE], w)
            return total

        pairs, *found = _summed(train, sums)
        found = np.array(found) / pairs
        curve = found[1 + size :].reshape(size, size) + RIDGE * np.eye(size)
        return found[0] + RIDGE / 2 * (w @ w), found[1 : 1 + size] + RIDGE * w, curve

    w = np.zeros(size)
    loss, grad, curve = at(w)
    for _ in range(STEPS):
        step, share = np.linalg.solve(curve, grad), 1.0
        gain = grad @ step
        if gain < TOLERANCE:
            break
        new = at(w - step)
        while new[0] > loss - 1e-4 * share * gain and share > 1e-3:
            share /= 2
            new = at(w - share * step)
        w, (loss, grad, curve) = w - share * step, new
    return mean, scale, w, *_cut_and_width(rows, mean, scale, w, n_good, n_bad)


def _cut_and_width(rows: DataFrame, mean, scale, w: np.ndarray, n_good: int, n_bad: int) -> tuple[float, float]:
    """The score quantile at the share of worse rows, in the middle of the gap there, and the spread.

    Scores, each once with its number of rows, are sorted by ranges; a row for each range
    reaches the driver.
    """

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_standard(_arrays(b)[0], mean, scale) @ w)], ["raw"])

    values = rows.mapInArrow(score, "raw double").groupBy("raw").agg(F.count("*").alias("n"))
    ordered = staged(values.repartitionByRange("raw").withColumn("part", F.spark_partition_id()), "quality-scores")
    sizes = sorted(map(tuple, ordered.groupBy("part").agg(F.sum("n")).collect()))
    before = [(part, sum(n for _, n in sizes[:i])) for i, (part, _) in enumerate(sizes)]
    starts = rows.sparkSession.createDataFrame(before, "part int, before long")
    count = n_good + n_bad
    share, last = n_bad / count, count - 1
    low, high = int(max(share - 0.01, 0) * last), int(np.ceil(min(share + 0.01, 1) * last))
    in_order = Window.partitionBy("part").orderBy("raw")
    placed = ordered.withColumn("upto", F.sum("n").over(in_order)).join(F.broadcast(starts), "part")
    upto = F.col("before") + F.col("upto")  # rows up to and with this score
    near = placed.filter((upto > low) & (upto - F.col("n") <= high))
    gaps = near.withColumn("gap", F.lead("raw").over(in_order) - F.col("raw"))
    ends = gaps.groupBy("part").agg(
        F.min("raw").alias("first"),
        F.max("raw").alias("last"),
        F.max(F.when(F.col("gap").isNotNull(), F.struct("gap", (-F.col("raw")).alias("under")))).alias("widest"),
    )
    found, upto = [], None
    for r in sorted(ends.collect()):
        if upto is not None:
            found.append((r.first - upto, -upto))
        if r.widest is not None:
            found.append(tuple(r.widest))
        upto = r.last
    gap, under = max(found, default=(0.0, -(upto or 0.0)))
    one, two = ordered.agg(F.sum(F.col("n") * F.col("raw")), F.sum(F.col("n") * F.col("raw") ** 2)).first()
    width = max(two / count - (one / count) ** 2, 0.0) ** 0.5 + 1e-9
    return gap / 2 - under, float(f"{width:.12g}")  # without the digits that hang on the order of a sum


def _scores(features: np.ndarray, model) -> np.ndarray:
    mean, scale, w, cut, width = model
    if not w.any():
        return np.full(len(features), 0.5)
    return 1 / (1 + np.exp(-np.clip((_standard(features, mean, scale) @ w - cut) / width * SPREAD, -30, 30)))


def fit_quality(features: DataFrame, labels: DataFrame):
    """The model from all labelled rows that are not held out.

    Ids whose labels differ or are null, or that have no text row, teach nothing.  Only sums
    over rows and ends of ranges reach the driver.
    """
    marks = labels.groupBy("doc_id").agg(F.avg("quality").alias("quality")).filter(
        "quality in (0, 1)"
    )
    known = features.filter(~held_out()).join(marks, "doc_id")
    counts = dict(map(tuple, known.groupBy("quality").count().collect()))
    n_good, n_bad = counts.get(1.0, 0), counts.get(0.0, 0)
    return fit_pairs(staged(buckets(known, n_good, n_bad), "quality-pairs"), n_good, n_bad)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null text scores as the empty one, a null id is never held out, repeated rows each get
    their own (equal) row, and further columns are ignored.  Without labels of both kinds
    every score is one half.
    """
    feats = staged(document_features(docs), "quality-features")
    model = fit_quality(feats, labels)

    def score(frames):
        for f in frames:
            x = np.array(f["features"].tolist(), float).reshape(len(f), FEATURES)
            yield f.drop(columns="features").assign(score=_scores(x, model))

    scored = feats.select("doc_id", held_out().alias("held_out"), "features").mapInPandas(
        score, "doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored under one half, all columns kept, nothing shuffled."""
    model = fit_quality(staged(document_features(docs), "quality-features"), labels)
    at = docs.columns.index("text")

    def good(batches):
        member = space_words()
        for b in batches:
            rows = [features_of((t.as_py() or "").encode("utf-8", "surrogatepass"), member) for t in b.column(at)]
            keep = _scores(np.array(rows, np.float32).astype(float).reshape(len(rows), FEATURES), model) >= 0.5
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(good, docs.schema)

