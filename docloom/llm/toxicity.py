"""Toxicity by a subsequence string kernel and a Nyström support vector machine.

The kernel counts common subsequences of three characters, gaps allowed, each weighted by
``DECAY`` to the power of the span it covers, so ``id-iot`` and ``idxiot`` stay close to
``idiot``.  A sentence's or document's margin is that of its most toxic word; a machine
over a fixed number of landmarks is linear in the kernel's features, hence one table of
weights per triple scores any word.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import held_out, staged, text_or_empty

DECAY = 0.5
ALPHABET = 64
WINDOW = 18
TRAIN_ROWS = 20000
POSITIVES = 400
NEGATIVES = 6000
LANDMARKS = 512
ROUNDS = 3
SLOPE = 6.0
CACHE_WORDS = 300_000
ROWS_AT_ONCE = 500
# Single characters set apart by blanks are read as one word.
SPACED = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")
SENTENCE = re.compile(r"[.!?\n]+\s*")


def ascii_lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def spaced_words(text: str) -> list[str]:
    return [re.sub(r"\s", "", m) for m in SPACED.findall(text)]


def letters_of(word: str) -> str:
    """The letters and digits of a word; marks inside it are gaps and go."""
    return "".join(c for c in word if c.isalnum())


def _code(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return {"^": 0, "$": 63}.get(c, 27 + ord(c) % 36)


_CODES: dict[str, int] = {}


def codes_of(word: str) -> list[int]:
    for c in word:
        if c not in _CODES:
            _CODES[c] = _code(c)
    return [_CODES[c] for c in word]


def windows_of(word: str) -> list[str]:
    """A word with marks at its ends; a long one in all its windows."""
    word = f"^{word}$"
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(len(word) - WINDOW + 1)]


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    if length not in _TRIPLES:
        at = np.array(list(itertools.combinations(range(length), 3)), np.int64)
        _TRIPLES[length] = at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)
    return _TRIPLES[length]


def kernel_features(words: list[str]):
    """For each word length: word places, triple codes and weights of the triples, normalised.

    Equal triples of a word are summed into the first of them, so a row's squared weights
    add up to one.
    """
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= 3:
            by_length.setdefault(len(w), []).append(i)
    for length, places in by_length.items():
        at, weight = _triples(length)
        for start in range(0, len(places), 2000):
            rows = places[start : start + 2000]
            c = np.array([codes_of(words[i]) for i in rows])
            code = (c[:, at[:, 0]] * ALPHABET + c[:, at[:, 1]]) * ALPHABET + c[:, at[:, 2]]
            order = np.argsort(code, axis=1, kind="stable")
            code = np.take_along_axis(code, order, axis=1)
            sums = np.cumsum(np.broadcast_to(weight, code.shape)[np.arange(len(rows))[:, None], order], axis=1)
            last = np.ones(code.shape, bool)
            last[:, :-1] = code[:, 1:] != code[:, :-1]
            upto = np.where(last, sums, 0)
            before = np.maximum.accumulate(upto, axis=1)
            value = np.where(last, sums - np.concatenate([np.zeros((len(rows), 1)), before[:, :-1]], axis=1), 0)
            norm = np.sqrt((value**2).sum(axis=1, keepdims=True))
            yield np.array(rows), code, value / norm


def kernel_norms(codes: np.ndarray) -> np.ndarray:
    """Root of each word's kernel with itself, for words of one length, by the recursion.

    Each of the three steps moves on in both copies of the word at once.
    """
    length = codes.shape[1]
    same = (codes[:, :, None] == codes[:, None, :]).astype(float)
    away = np.subtract.outer(np.arange(length), np.arange(length)).T
    on = np.where(away > 0, DECAY ** np.maximum(away, 0), 0.0)
    sums = same * DECAY**2
    for _ in range(2):
        sums = same * (on.T @ sums @ on)
    return np.sqrt(sums.sum(axis=(1, 2)))


def word_margins(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word; words of under three characters have the bias."""
    out = np.full(len(words), bias)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= 3:
            by_length.setdefault(len(w), []).append(i)
    for length, places in by_length.items():
        at, weight = _triples(length)
        for start in range(0, len(places), 2000):
            rows = places[start : start + 2000]
            c = np.array([codes_of(words[i]) for i in rows])
            code = (c[:, at[:, 0]] * ALPHABET + c[:, at[:, 1]]) * ALPHABET + c[:, at[:, 2]]
            out[rows] += (weights[code] @ weight) / kernel_norms(c)
    return out


def margins(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """As ``word_margins``, the largest over the windows of long words."""
    cut = [windows_of(letters_of(w)) for w in words]
    flat = list(itertools.chain.from_iterable(cut))
    scores = word_margins(flat, weights, bias)
    starts = np.cumsum([0, *map(len, cut)])[:-1]
    return np.maximum.reduceat(scores, starts) if len(words) else scores


def fit_machine(
    positive: list[str], negative: list[str], places: list[int]
) -> tuple[np.ndarray, float]:
    """Triple weights and bias of the support vector machine over Nyström landmarks.

    A positive weighs by the root of the number of places it was seen in.
    """
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    bent = []
    for w in positive:  # tolerance of one inserted or doubled character is taught
        i = int(rng.integers(2, len(w) - 1)) if len(w) > 3 else 1
        bent += [w[:i] + str(rng.choice(letters)) + w[i:], w[:i] + w[i - 1] + w[i:]]
    bent = [w[:WINDOW] for w in bent]
    half = LANDMARKS // 2
    marks = list(dict.fromkeys(positive[:half] + negative[:: max(1, len(negative) // half)][:half]))
    found = list(kernel_features(marks))
    active = np.unique(np.concatenate([code.ravel() for _, code, _ in found]))
    triples = np.zeros(ALPHABET**3, np.int64)
    triples[active] = np.arange(1, active.size + 1)
    base = np.zeros((len(marks), active.size), np.float32)
    for rows, code, value in found:
        np.add.at(base, (rows[:, None], triples[code] - 1), value.astype(np.float32))

    def near(words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(marks)))
        for rows, code, value in kernel_features(words):
            own = np.zeros((len(rows), active.size + 1), np.float32)
            np.add.at(own, (np.arange(len(rows))[:, None], triples[code]), value.astype(np.float32))
            out[rows] = own[:, 1:] @ base.T
        return out

    values, vectors = np.linalg.eigh(base.astype(float) @ base.T.astype(float))
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    words = positive + bent + negative
    x = near(words) @ root
    y = np.array([1.0] * (len(positive) + len(bent)) + [-1.0] * len(negative))
    weight = np.sqrt(np.array(places, float))
    weight = np.concatenate([weight, np.repeat(weight, 2) / 3])
    cost = np.append(0.5 * weight / weight.sum(), np.full(len(negative), 0.5 / max(len(negative), 1)))
    w, bias = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, 1001):
        slack = np.maximum(0, 1 - y * (x @ w + bias)) * cost * y
        grad = np.append(-2 * (slack @ x) + 5e-5 * w, -2 * slack.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    table = np.zeros(ALPHABET**3)
    table[active] = (root @ w) @ base
    return table, float(bias)


def _contexts(frames):
    """Words of labelled texts with the sentence-mates beside them, distinct per batch."""
    for f in frames:
        rows = set()
        for text, toxic in zip(f["text"], f["toxic"]):
            for sentence in SENTENCE.split(ascii_lower(text)):
                words = [w for w in map(letters_of, sentence.split()) if w]
                padded = ["", *words, ""]
                for a, w, b in zip(padded, words, padded[2:]):
                    if len(w) >= 3:
                        rows.update((u, f"{a} {b}", toxic) for u in windows_of(w))
        yield pd.DataFrame(list(rows), columns=["unit", "beside", "toxic"])


def train(docs: DataFrame, marks: DataFrame, train_rows: int):
    """The machine from at most ``train_rows`` labelled rows, or None without insults to learn.

    Words that stand in significantly more different places of toxic sentences than of
    clean ones are the positives; copies of one sentence count once.
    """
    picked = marks.orderBy(F.xxhash64("doc_id", F.lit("toxic"))).limit(train_rows)
    known = docs.join(F.broadcast(picked), "doc_id").select(text_or_empty().alias("text"), "toxic")
    places = known.mapInPandas(_contexts, "unit string, beside string, toxic int").distinct()
    units = staged(
        places.groupBy("unit").agg(
            F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
        ),
        "toxic-units",
    )
    a, b, n = units.agg(F.sum("a"), F.sum("b"), F.count("*")).first()
    if not a or not b:
        return None
    q = a / (a + b)
    p = F.col("a") / (F.col("a") + F.col("b"))
    surprise = F.col("a") * F.log(p / q) + F.when(
        F.col("b") > 0, F.col("b") * F.log((1 - p) / (1 - q))
    ).otherwise(0.0)
    strong = units.withColumn("surprise", surprise).filter((p > 0.8) & (p > q))
    found = [
        (r.unit, r.a)
        for r in strong.filter(F.col("surprise") > float(np.log(n) + 2))
        .orderBy(F.desc("surprise"), "unit")
        .limit(POSITIVES)
        .collect()
    ]
    if not found:
        return None
    positive, seen = [u for u, _ in found], [n for _, n in found]
    clean = units.filter("b > 0").filter(~F.col("unit").isin(positive)).select("unit", F.xxhash64("unit").alias("o"))
    negative = [r.unit for r in clean.orderBy("o", "unit").limit(NEGATIVES).collect()]
    model = fit_machine(positive, negative, seen)

    def hardest(frames):
        table, bias = model
        for f in frames:
            yield f[["unit"]].assign(margin=word_margins(f["unit"].tolist(), table, bias))

    for _ in range(ROUNDS):  # words of clean texts that the last machine ranks highest
        hard = clean.mapInPandas(hardest, "unit string, margin double")
        hard = hard.orderBy(F.desc("margin"), "unit").limit(NEGATIVES // 6).collect()
        negative = list(dict.fromkeys([r.unit for r in hard] + negative))
        model = fit_machine(positive, negative, seen)
    return model


def document_margins(docs: DataFrame, model) -> DataFrame:
    def run(frames):
        table, bias = model
        seen: dict[str, float] = {}
        for f in frames:
            best: list[float] = []
            for start in range(0, len(f), ROWS_AT_ONCE):
                texts = [ascii_lower(t) for t in f["text"].iloc[start : start + ROWS_AT_ONCE]]
                words = [{*t.split(), *spaced_words(t)} for t in texts]
                new = list(set().union(*words).difference(seen))
                seen.update(zip(new, margins(new, table, bias).tolist()))
                best += [max(map(seen.__getitem__, w), default=bias) for w in words]
                if len(seen) > CACHE_WORDS:
                    seen.clear()
            yield f[["doc_id", "held_out"]].assign(margin=best)

    return docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text")).mapInPandas(
        run, "doc_id long, held_out boolean, margin double"
    )


def _calibrate(margin: np.ndarray, y: np.ndarray) -> float:
    """The margin above which labels are best taken for toxic; midway between its rows."""
    if not len(y) or y.min() == y.max():
        return 0.0
    order = np.argsort(-margin, kind="stable")
    m, t = margin[order], y[order]
    wrong = np.cumsum(2 * (t == 0)) - np.cumsum(t == 1)  # a clean text flagged weighs double
    ends = np.flatnonzero(np.append(m[1:] < m[:-1], True))
    at = ends[int(np.argmin(wrong[ends]))]
    return float((m[at] + m[min(at + 1, len(m) - 1)]) / 2)


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Learns from at most ``train_rows`` labelled ids that are not held out (smallest hash
    first; ids whose labels differ or are null teach nothing).  A null text scores as the
    empty one, which has no word and so the lowest margin; null ids are never held out;
    repeated rows each get their row; further columns are ignored.  Without anything to
    learn every score is 0.
    """
    marks = (
        labels.filter("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("_most"))
        .filter("toxic = _most and toxic in (0, 1)")
        .drop("_most")
        .filter(~held_out())
    )
    model = train(docs, marks, train_rows)
    if model is None:
        return docs.select(
            "doc_id", held_out().alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted")
        )
    found = staged(document_margins(docs, model), "toxic-margins")
    picked = marks.orderBy(F.xxhash64("doc_id", F.lit("toxic"))).limit(train_rows)
    # Copies weigh as one: a row per margin and label.
    known = found.join(F.broadcast(picked), "doc_id").select("margin", "toxic").distinct().limit(train_rows)
    rows = known.collect()
    mid = _calibrate(np.array([r.margin for r in rows]), np.array([r.toxic for r in rows]))
    score = 1 / (1 + F.exp(-(F.col("margin") - mid) * SLOPE - float(np.log(0.7 / 0.3))))
    return found.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int")
    )
