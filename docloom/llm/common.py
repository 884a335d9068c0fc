"""Helpers the operators share: tables, written stages, id sieves and word hashes."""

from __future__ import annotations

import functools
import gc
import sys
import types
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import delete, stage_path

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PIECE_BYTES = 1 << 16
SIEVE_BITS = 1 << 23
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes a stage to the cluster's shared folder and reads it back.

    Cuts lineage and survives lost executors; later readers get column pruning.
    """
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stage = path
    return out


def unstage(*stages: DataFrame) -> None:
    """Removes written stages that nothing reads any more, and shuffle files with them."""
    for df in stages:
        delete(df.sparkSession, df._stage)
    sweep(stages[0].sparkSession)


def sweep(spark: SparkSession) -> None:
    """Has the files of finished shuffles removed, as after a stage is written.

    Spark drops them once the driver's garbage collector has found that no plan needs them, so
    it is asked to look.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def kept_by_worker(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, once for each Python process that runs tasks.

    Functions travel with their module's code, so its globals live as long as a task; this
    outlives it.  What is kept bounds its own size.
    """
    held = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_mark(column: str = "text") -> Column:
    """Tells rows of one id with different texts apart; equal rows share it."""
    return F.xxhash64(F.col(column))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows of ``gone (doc_id, mark)``, all columns kept."""
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("mark").alias("_gone_mark")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_mark"])
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti")


def held_out() -> Column:
    """Rows whose labels may not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


# --- Sieve: which ids are wanted, in a bit set of fixed size -----------------------------


def sieve(h: Column, rows: DataFrame, bits: int = SIEVE_BITS) -> np.ndarray:
    """A Bloom filter of fixed size over the 64-bit hashes ``h``.

    It lets a scan drop most unwanted rows before their texts are shuffled; an exact
    join follows.  The driver sees ``bits / 64`` words at most, whatever the row count.
    """
    spots = F.array(F.pmod(h, F.lit(bits)), F.pmod(F.shiftrightunsigned(h, 31), F.lit(bits)))
    words = (
        rows.select(F.explode(spots).alias("spot"))
        .groupBy(F.shiftright("spot", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("mask"))
    )
    out = np.zeros(bits >> 6, np.uint64)
    for word, mask in words.collect():
        out[word] = np.uint64(mask & 0xFFFFFFFFFFFFFFFF)
    return out


def sieve_bits(n: int) -> int:
    """A size at which a sieve over ``n`` hashes lets one in some hundred others through.

    From 1 to 64 MB; beyond 30 million hashes more pass, which costs time, not rows.
    """
    bits = SIEVE_BITS
    while bits < 16 * n and bits < 1 << 29:
        bits *= 2
    return bits


def in_sieve(filt: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the sieve."""
    bits = np.uint64(filt.size << 6)
    h = hashes.view(np.uint64) if hashes.dtype != np.uint64 else hashes
    # pmod of a signed value by a power of two is its low bits.
    one = h & (bits - np.uint64(1))
    two = (h >> np.uint64(31)) & (bits - np.uint64(1))

    def has(spot: np.ndarray) -> np.ndarray:
        return (filt[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1)

    return (has(one) & has(two)).astype(bool)


# --- Word hashes ------------------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values() -> np.ndarray:
    """A random 64-bit value per byte; A-Z share those of a-z."""
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and their inverses."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        ups = np.full(n, np.uint64(base))
        downs = np.full(n, np.uint64(inverse))
        ups[0] = downs[0] = 1
        return np.cumprod(ups, dtype=np.uint64), np.cumprod(downs, dtype=np.uint64)


def space_words() -> np.ndarray:
    """Bytes of words that end at ASCII white space."""
    member = np.ones(256, bool)
    member[list(SPACE_BYTES)] = False
    return member


def alnum_words() -> np.ndarray:
    """Bytes of words of ASCII letters, digits and everything beyond ASCII."""
    member = np.zeros(256, bool)
    member[48:58] = member[65:91] = member[97:123] = member[128:] = True
    return member


def word_hashes(data: bytes, member: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of a text, A-Z lower-cased, in order.

    Works in pieces that end between words, so memory follows the piece and the
    number of words; a longer word makes its piece longer.
    """
    a = np.frombuffer(data, np.uint8)
    if a.size <= PIECE_BYTES:
        return _piece_hashes(a, member)
    parts, start = [], 0
    while start < a.size:
        end = min(start + PIECE_BYTES, a.size)
        while end < a.size:
            gaps = np.flatnonzero(~member[a[start:end]])
            if gaps.size:
                end = start + int(gaps[-1]) + 1
                break
            end = min(end + PIECE_BYTES, a.size)
        parts.append(_piece_hashes(a[start:end], member))
        start = end
    return np.concatenate(parts)


def _piece_hashes(a: np.ndarray, member: np.ndarray) -> np.ndarray:
    inside = np.zeros(a.size + 2, np.int8)
    inside[1:-1] = member[a]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not starts.size:
        return np.zeros(0, np.uint64)
    size = PIECE_BYTES
    while size < a.size:
        size *= 2
    ups, downs = _powers(size)
    sums = np.zeros(a.size + 1, np.uint64)
    np.cumsum(_byte_values()[a] * ups[: a.size], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * downs[starts])
