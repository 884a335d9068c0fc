"""Vector codes: parts of vectors coded by the nearest entry of codebooks learnt in rounds.

Vectors become integers and are written once in blocks, each with a dictionary of the distinct
integers of every dimension.  A round tabulates the squared differences of every distinct
integer to all entries; a part's distances are then rows of these tables, gathered by the
dictionary codes and added up.  Spark sums the parts of every entry; the driver sees one row for
each entry of the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK_ROWS = 8192
BLOCK_NUMBERS = 1 << 20
STRIP_ROWS = 1024
# Integers beyond this count as this: their squares have no place in a result anyway.
MOST = 1 << 62
LONG = (1 << 63) - 1
SMALL_LABELS = 100_000


def usable(embedding: Column) -> Column:
    """A vector without null or non-finite components."""
    inf = F.lit(float("inf"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)
    return embedding.isNotNull() & F.coalesce(F.forall(embedding, fine), F.lit(False))


def _integers(rows: list, width: int) -> np.ndarray:
    """``floor(1024 x)`` of each component; shorter vectors end in zeros."""
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        with np.errstate(over="ignore"):
            x = np.floor(np.asarray(row, np.float64) * SCALE)
        # The clip is done on integers: 2**62 has neighbours in double precision only far off.
        out[i, : x.size] = np.where(np.abs(x) < MOST, x, 0).astype(np.int64) + np.where(
            np.abs(x) < MOST, 0, np.sign(x).astype(np.int64) * MOST
        )
    return out


def _blocks(kept: DataFrame, width: int) -> DataFrame:
    """``vec_ids, labels, sizes, values, codes``: rows by block, dictionaries behind each other."""
    label = dict(kept.dtypes)["label"]
    rows = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // max(width, 1)))

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                b = batch.slice(low, rows)
                x = _integers([v.values.to_numpy(zero_copy_only=False) for v in b.column(2)], width)
                sizes, values, codes = [], [], np.zeros((width, x.shape[0]), "<u2")
                for d in range(width):
                    distinct, codes[d] = np.unique(x[:, d], return_inverse=True)
                    sizes.append(distinct.size)
                    values.append(distinct)
                listed = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
                yield pa.RecordBatch.from_arrays(
                    [
                        listed(b.column(0)),
                        listed(b.column(1)),
                        pa.array([sizes], pa.list_(pa.int32())),
                        pa.array([np.concatenate([np.zeros(0, np.int64), *values])], pa.list_(pa.int64())),
                        pa.array([codes.tobytes()], pa.binary()),
                    ],
                    ["vec_ids", "labels", "sizes", "values", "codes"],
                )

    fields = f"vec_ids array<long>, labels array<{label}>, sizes array<int>, values array<long>, codes binary"
    return kept.select("vec_id", "label", "embedding").mapInArrow(run, fields)


class Block:
    """A block's dictionaries and codes."""

    def __init__(self, sizes: np.ndarray, values: np.ndarray, codes: bytes):
        cuts = np.cumsum(sizes)[:-1]
        self.values = np.split(values, cuts) if sizes.size else []
        self.codes = np.frombuffer(codes, "<u2").reshape(sizes.size, -1) if sizes.size else np.zeros((0, 0), "<u2")

    def part(self, dims: range) -> np.ndarray:
        """The integers of some dimensions, a row for each vector."""
        return np.stack([self.values[d][self.codes[d]] for d in dims], axis=1)

    def nearest(self, dims: range, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each vector's part and its distance; ties go to the lower entry."""
        n = self.codes.shape[1]
        found, away = np.zeros(n, np.int64), np.zeros(n, object)
        spans = [max(int(self.values[d].max()), int(e.max())) - min(int(self.values[d].min()), int(e.min())) for d, e in zip(dims, entries.T)]
        most = sum(s * s for s in spans)
        kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 62 else object
        # Squared differences of every distinct integer to all entries.
        tables = [(self.values[d].astype(kind)[:, None] - e.astype(kind)[None, :]) ** 2 for d, e in zip(dims, entries.T)]
        for low in range(0, n, STRIP_ROWS):
            strip = slice(low, min(low + STRIP_ROWS, n))
            total = np.zeros((strip.stop - low, len(entries)), kind)
            for d, t in zip(dims, tables):
                total += t[self.codes[d, strip]]
            best = total.argmin(axis=1)
            found[strip] = best
            away[strip] = total[np.arange(best.size), best].tolist()
        return found, away


def _part_dims(width: int) -> list[range]:
    return [range(p * width // PARTS, (p + 1) * width // PARTS) for p in range(PARTS)]


def _read(batch: pa.RecordBatch, i: int) -> Block:
    list_of = lambda c: c[i].values.to_numpy(zero_copy_only=False)
    return Block(list_of(batch.column("sizes")), list_of(batch.column("values")), batch.column("codes")[i].as_py())


def _sums(width: int, books: np.ndarray) -> Callable[[Iterator], Iterator]:
    """Sums and counts of the parts nearest to each entry, one row for each entry of a task."""

    def run(batches):
        dims = _part_dims(width)
        totals: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = _read(batch, i)
                for p, own in enumerate(dims):
                    found, _ = block.nearest(own, books[:, own.start : own.stop])
                    x = block.part(own)
                    order = np.argsort(found, kind="stable")
                    x, found = x[order], found[order]
                    if max(-int(x.min()), int(x.max())) * len(x) > LONG:
                        x = x.astype(object)
                    cuts = np.concatenate([[0], np.flatnonzero(np.diff(found)) + 1])
                    sizes = np.diff(np.append(cuts, found.size))
                    for entry, count, total in zip(found[cuts].tolist(), sizes.tolist(), np.add.reduceat(x, cuts, axis=0)):
                        before = totals.get((p, entry), (0, 0))
                        totals[p, entry] = (before[0] + count, before[1] + total.astype(object))
        rows = sorted(totals.items())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k, _ in rows], pa.int32()),
                pa.array([k[1] for k, _ in rows], pa.int32()),
                pa.array([v[0] for _, v in rows], pa.int64()),
                pa.array([[str(x) for x in v[1]] for _, v in rows], pa.list_(pa.string())),
            ],
            ["part", "entry", "n", "sums"],
        )

    return run


def _next(blocks: DataFrame, width: int, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: every used entry moves to the floor of its parts' mean."""
    deep = max(len(d) for d in _part_dims(width))
    exact = F.transform("sums", lambda x: x.cast("decimal(38,0)"))
    partial = blocks.select("sizes", "values", "codes").mapInArrow(
        _sums(width, books), "part int, entry int, n long, sums array<string>"
    )
    summed = (
        partial.select("part", "entry", "n", exact.alias("sums"))
        .groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(deep)]).alias("sums"))
    )
    out = books.copy()
    dims = _part_dims(width)
    for part, entry, n, sums in summed.collect():  # PARTS x ENTRIES rows at most
        own = dims[part]
        out[entry, own.start : own.stop] = [int(s) // n for s in sums[: len(own)]]
    return out


def _coded(blocks: DataFrame, width: int, books: np.ndarray, label: str) -> DataFrame:
    def run(batches):
        dims = _part_dims(width)
        for batch in batches:
            for i in range(batch.num_rows):
                block = _read(batch, i)
                ids, labels = batch.column("vec_ids")[i].values, batch.column("labels")[i].values
                codes, error = np.zeros((len(ids), PARTS), np.uint8), np.zeros(len(ids), object)
                for p, own in enumerate(dims if width else []):
                    found, away = block.nearest(own, books[:, own.start : own.stop])
                    codes[:, p] = found
                    error += away
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        labels,
                        pa.array([c.tobytes().hex() for c in codes], pa.string()),
                        pa.array([min(e, LONG) for e in error.tolist()], pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def book_lines(books: np.ndarray) -> str:
    """All integers by part, entry and place within the part, joined by commas."""
    dims = _part_dims(books.shape[1])
    return ",".join(str(x) for own in dims for x in books[:, own.start : own.stop].ravel().tolist())


def learn(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The written blocks of all usable vectors, and the codebooks after all rounds (entry, dimension)."""
    kept = vectors.select("vec_id", "label", "embedding").filter(usable(F.col("embedding")))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    books = _integers([r[0] for r in first], width)
    blocks = staged(_blocks(kept, width), "vector-blocks")
    for _ in range(ROUNDS if width and len(books) else 0):
        books = _next(blocks, width, books)
    return blocks, books


def compress(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per usable row of ``vectors``.

    Vectors that are null or hold null or non-finite components are left out; an empty vector
    stays.  Where lengths differ, or are no multiple of four, vectors end in zeros up to the
    longest one's next multiple.  A null id keeps its row and comes last among the first
    entries, rows of one id in the order of their vectors; repeated rows each count.  Null
    labels are one label.  With fewer vectors than entries the codebooks are as short.  An
    error too large for a long is the greatest long, and so is a label's sum.  An empty table gives no rows; further columns are
    ignored.

    What goes to every task is the codebooks; the driver sees them and no vectors but the
    first entries.
    """
    spark = vectors.sparkSession
    blocks, books = learn(vectors)
    label = dict(vectors.dtypes)["label"]
    rows = staged(_coded(blocks, books.shape[1], books, label), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = rows.groupBy(F.col("label").alias("_label")).agg(
        F.least(total, F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    sums = staged(sums, "vector-labels")
    if sums.count() <= SMALL_LABELS:  # a few MB
        sums = F.broadcast(sums)
    digest = hashlib.sha256(book_lines(books).encode()).hexdigest()
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _sql() -> str:
    nearest = """a{r} AS MATERIALIZED (
  SELECT row, part, entry, d FROM (
    SELECT p.row, p.part, c.entry, sum((p.x - c.x) * (p.x - c.x)) AS d
    FROM p JOIN c{r} c USING (part, pos) GROUP BY p.row, p.part, c.entry)
  QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY d, entry) = 1)"""
    moved = """c{n} AS MATERIALIZED (
  SELECT c.part, c.entry, c.pos,
    CASE WHEN m.n IS NULL THEN c.x ELSE CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS x
  FROM c{r} c LEFT JOIN (
    SELECT a.part, a.entry, p.pos, sum(p.x) AS s, count(*) AS n
    FROM a{r} a JOIN p USING (row, part) GROUP BY a.part, a.entry, p.pos) m USING (part, entry, pos))"""
    rounds = ",\n".join(nearest.format(r=r) + ",\n" + moved.format(r=r, n=r + 1) for r in range(ROUNDS))
    return f"""WITH k AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT (max(len(embedding)) + {PARTS - 1}) // {PARTS} AS deep FROM k),
p AS MATERIALIZED (
  SELECT row, (i // deep) AS part, (i % deep) AS pos,
    coalesce(CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT), 0) AS x
  FROM k, w, range({PARTS} * (SELECT deep FROM w)) t(i)),
c0 AS MATERIALIZED (SELECT part, row AS entry, pos, x FROM p WHERE row < {ENTRIES}),
{rounds},
{nearest.format(r=ROUNDS)},
e AS (
  SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY row),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM e JOIN k USING (row) GROUP BY label),
s AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT k.vec_id, e.code, e.error, l.label_error, s.codebooks_sha256
FROM k JOIN e USING (row) JOIN l ON k.label IS NOT DISTINCT FROM l.label CROSS JOIN s"""


SQL = _sql()
