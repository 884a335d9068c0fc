"""Approximate nearest neighbours over learned partitions.

A balanced partitioning of a sample's neighbour graph gives classes; a small classifier
learns them and routes every vector to its class and every query to its most probable ones,
where an exact rerank follows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import staged

SAMPLE_PER_PART = 128
GRAPH_DEGREE = 20
MAX_PARTS = 256
HELD_ROWS = 2000
HIDDEN = 128
STEPS = 600
TARGET = 0.96
SHELF_ROWS = 16384
BLOCK_QUERIES = 2048
QUERIES_AT_ONCE = 256
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Row numbers of each row's nearest others, by inner product."""
    out = np.empty((len(x), degree), np.int64)
    for start in range(0, len(x), 1024):
        sims = x[start : start + 1024] @ x.T
        sims[np.arange(len(sims)), np.arange(start, start + len(sims))] = -np.inf
        out[start : start + 1024] = np.argpartition(-sims, degree - 1, axis=1)[:, :degree]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Part of each row, all of one size up to one row, few graph edges between parts.

    Starts from halves along main axes; then rows move, best gain first, to the part that
    holds most of their neighbours, as far as the parts' sizes allow.
    """
    label = np.zeros(len(x), np.int64)
    queue = [(np.arange(len(x)), 0, parts)]
    while queue:
        rows, first, n = queue.pop()
        if n == 1:
            label[rows] = first
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        at = len(rows) * (n // 2) // n
        queue += [(order[:at], first, n // 2), (order[at:], first + n // 2, n - n // 2)]
    room = int(np.ceil(len(x) / parts * 1.05)) + 1
    reverse = [[] for _ in range(len(x))]
    for i, row in enumerate(graph):
        for j in row:
            reverse[j].append(i)
    both = [np.concatenate([graph[i], np.array(r, np.int64)]) for i, r in enumerate(reverse)]
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for i in np.random.default_rng(3).permutation(len(x)):
            votes = np.bincount(label[both[i]], minlength=parts)
            votes[size >= room] = -1
            best = int(np.argmax(votes))
            if votes[best] > np.sum(label[both[i]] == label[i]):
                size[label[i]] -= 1
                size[best] += 1
                label[i] = best
                moved += 1
        if not moved:
            break
    return label


def fit_router(x: np.ndarray, target: np.ndarray):
    """A one-layer network from vectors to part probabilities; targets are distributions."""
    rng = np.random.default_rng(9)
    n, d = x.shape
    parts = target.shape[1]
    p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, parts)), np.zeros(parts)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for t in range(1, STEPS + 1):
        pick = rng.integers(0, n, 512)
        xb, yb = x[pick], target[pick]
        h = np.maximum(xb @ p[0] + p[1], 0)
        z = h @ p[2] + p[3]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        g = (e / e.sum(axis=1, keepdims=True) - yb) / len(pick)
        gh = (g @ p[2].T) * (h > 0)
        for i, grad in enumerate([xb.T @ gh, gh.sum(0), h.T @ g, g.sum(0)]):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad**2
            p[i] = p[i] - 0.004 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return p


def route(x: np.ndarray, router, top: int) -> np.ndarray:
    """The ``top`` most probable parts of each row, best first."""
    z = np.maximum(x @ router[0] + router[1], 0) @ router[2] + router[3]
    return np.argsort(-z, axis=1, kind="stable")[:, :top]


def learn(sample: np.ndarray, parts: int, k: int):
    """Router, and the number of probes that reach ``TARGET`` on rows kept out of the fit.

    Those rows, every fifth different one, ask for their ``k`` nearest of the whole sample by
    the raw inner product; two standard errors of their mean recall must lie above the target.  A sample's
    neighbours are farther than those of the whole table, so the whole does no worse.
    """
    x = unit(sample)
    different = np.sort(np.unique(sample, axis=0, return_index=True)[1])
    held = different[::5][:HELD_ROWS]
    fit = np.ones(len(x), bool)
    fit[held] = False
    degree = min(GRAPH_DEGREE, int(fit.sum()) - 1)
    if parts < 2 or degree < 1:
        return None, 1
    graph = neighbour_graph(x[fit], degree)
    label = balanced_parts(x[fit], graph, parts)
    rows = np.arange(len(label))
    target = np.zeros((len(label), parts))
    target[rows, label] += degree / 2
    for j in range(degree):
        np.add.at(target, (rows, label[graph[:, j]]), 1)
    router = fit_router(x[fit], target / target.sum(axis=1, keepdims=True))
    part = route(x, router, 1)[:, 0]
    order = route(x[held], router, parts)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(held), 0), axis=1)
    k = min(k, len(x) - 1)
    near = np.empty((len(held), k), np.int64)
    for start in range(0, len(held), QUERIES_AT_ONCE):
        own = held[start : start + QUERIES_AT_ONCE]
        sims = sample[own] @ sample.T
        sims[np.arange(len(own)), own] = -np.inf
        best = np.argsort(-sims, axis=1, kind="stable")[:, :k]  # ties by the sample's order
        near[start : start + len(own)] = np.take_along_axis(place[start : start + len(own)], part[best], axis=1)
    for probes in range(1, parts + 1):
        recall = (near < probes).mean(axis=1)
        if recall.mean() - 2 * recall.std() / len(recall) ** 0.5 >= TARGET:
            break
    return router, probes


def top_of(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, allowed, k: int):
    """For each query its ``k`` best rows: larger product first, then smaller id.

    ``allowed(rows)`` says for some of the queries which rows they may take.
    """
    out_q, out_x, out_s = [], [], []
    for start in range(0, len(q), QUERIES_AT_ONCE):
        rows = np.arange(start, min(start + QUERIES_AT_ONCE, len(q)))
        rough = np.where(allowed(rows), q[rows] @ x.T, -np.inf)
        rough[qid[rows][:, None] == xid[None, :]] = -np.inf
        for i, row in zip(rows, rough):
            n = np.isfinite(row).sum()
            if n > k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                some = np.flatnonzero(row >= least - SLACK * max(1.0, abs(least)))
            else:
                some = np.flatnonzero(np.isfinite(row))
            exact = (x[some] * q[i]).sum(axis=1)  # row by row, so equal vectors score equal
            best = np.lexsort((xid[some], -exact))[:k]
            out_q.append(np.full(len(best), qid[i]))
            out_x.append(xid[some][best])
            out_s.append(exact[best])
    return np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_s)


def shelve(sizes: dict[int, int], room: int) -> dict[int, tuple[int, int]]:
    """``part -> (shelf, chunks)``: small parts share shelves, large ones are cut in chunks."""
    out: dict[int, tuple[int, int]] = {}
    shelf, held = -1, room
    for part, size in sorted(sizes.items()):
        if size > room or held + size > room:
            shelf, held = shelf + 1, 0
        held += size
        out[part] = shelf, -(-size // room)
    return out


def nearest(vectors: DataFrame, queries: Column, k: int = 20, parts: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows found for each query row.

    ``queries`` is a condition on ``vec_id``.  There are a quarter as many ``parts`` as the
    root of the number of rows, at most ``MAX_PARTS``, and the model is fitted on at most
    ``SAMPLE_PER_PART`` vectors for each, those with the smallest hash of their id; every
    vector is indexed.  Vectors that are null, zero or hold null or non-finite components, and
    rows without id, take no part; of rows that repeat an id the one with the smallest vector
    counts; vectors shorter than the longest of the table are padded with zeros.  Parts share
    shelves of at most ``SHELF_ROWS`` rows, so a query answers once for several parts; a larger
    part is cut into chunks, and queries into blocks, by hash of the id, and each chunk meets
    each block: a group is bounded however many copies of a vector there are.
    """
    usable = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0),
        F.lit(False),
    )
    base = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(usable)
    base = staged(base.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "ann-vectors")
    n, longest = base.agg(F.count("*"), F.max(F.size("embedding"))).first()
    parts = parts or min(MAX_PARTS, max(1, -(-math.isqrt(n) // 4)))
    picked = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_PER_PART * parts).collect()
    width = longest or 1
    sample = _padded([r.embedding for r in picked], width)
    router, probes = learn(sample, parts, k)

    def assign(top: int):
        def run(frames):
            for f in frames:
                x = _padded(f["embedding"], width)
                best = route(unit(x), router, top) if router is not None else np.zeros((len(f), 1), np.int64)
                yield pd.DataFrame({"vec_id": f["vec_id"], "embedding": list(x), "parts": list(best)})

        return run

    fields = "vec_id long, embedding array<double>, parts array<int>"
    rows = base.mapInPandas(assign(1), fields).select("vec_id", "embedding", F.get("parts", 0).alias("part"))
    rows = staged(rows, "ann-index")
    sizes = {r.part: r["count"] for r in rows.groupBy("part").count().collect()}  # a row per part
    smallest = np.cumsum(sorted(sizes.values()))
    while probes < len(sizes) and smallest[probes - 1] <= k:
        probes += 1
    shelves = shelve(sizes, SHELF_ROWS)

    def ask(frames):
        for f in assign(probes)(frames):
            out = []
            for i, v, best in zip(f["vec_id"], f["embedding"], f["parts"]):
                wanted: dict[int, list[int]] = {}
                for part in best:
                    if int(part) in shelves:
                        wanted.setdefault(shelves[int(part)][0], []).append(int(part))
                out += [(shelf, i, v, some) for shelf, some in wanted.items()]
            yield pd.DataFrame(out, columns=["shelf", "vec_id", "embedding", "parts"])

    asked = base.filter(queries).mapInPandas(
        ask, "shelf int, vec_id long, embedding array<double>, parts array<int>"
    )
    asked = staged(asked, "ann-queries")
    blocks = {r.shelf: -(-r["count"] // BLOCK_QUERIES) for r in asked.groupBy("shelf").count().collect()}
    cuts = vectors.sparkSession.createDataFrame(
        [(p, s, c, blocks[s]) for p, (s, c) in shelves.items() if s in blocks],
        "part int, shelf int, chunks int, blocks int",
    )
    cuts = F.broadcast(cuts)  # at most MAX_PARTS rows
    by_shelf = F.broadcast(cuts.groupBy("shelf").agg(F.max("chunks").alias("chunks"), F.max("blocks").alias("blocks")))
    mine = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = rows.join(cuts, "part").withColumn("chunk", mine("chunks")).withColumn("block", each("blocks"))
    asks = asked.join(by_shelf, "shelf").withColumn("block", mine("blocks")).withColumn("chunk", each("chunks"))
    keys = ["shelf", "chunk", "block"]
    met = own.select(*keys, F.lit(False).alias("asks"), "vec_id", "embedding", F.array("part").alias("parts")).unionAll(
        asks.select(*keys, F.lit(True).alias("asks"), "vec_id", "embedding", "parts")
    )

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        is_query = frame["asks"].to_numpy()
        q, x = frame[is_query], frame[~is_query]
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        probed = np.zeros((len(q), parts), bool)
        for i, some in enumerate(q["parts"]):
            probed[i, some] = True
        part = np.array([p[0] for p in x["parts"]])
        found = top_of(
            _padded(q["embedding"], width),
            q["vec_id"].to_numpy(),
            _padded(x["embedding"], width),
            x["vec_id"].to_numpy(),
            lambda rows: probed[rows][:, part],
            k,
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    found = met.groupBy(*keys).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _padded(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out
