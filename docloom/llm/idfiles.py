"""Token ids as files of Simple-8b words.

A word of 64 bits holds a selector in its top four bits and, by that, 1 to 60 ids of 60 to 1
bits, or 120 zeros.  An id of over 60 bits is an exception: its word has selector 0 and the
number of the id in the shard's list of exceptions.  Ids lie in blocks of ``BLOCK``, each of which starts a word
of its own; the shard lists where.  So any range of blocks is decoded without those before it,
all words of one selector at once.

A shard is one file, little-endian: ``HEADER``, the documents' ids, flags (1: null id) and
ends (ids up to and with this document's), the blocks' first words, the words, the exceptions
and one line feed.  It is a record of Spark's text writer with a file for every record, so
any store Spark reaches will do, and a lost task leaves nothing behind.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.bpe import _SYMBOLS, PLAIN
from docloom.llm.common import kept_by_worker, staged, text_or_empty
from docloom.session import stage_path

# Fixed values of the format: bits and number of ids by selector, 0 being the exception.
BITS = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0)
COUNTS = (1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 120)
MAGIC = b"ids8b\x00\x00\x01"
# magic, part, shard, documents, ids, blocks, words, exceptions
HEADER = "<8s7Q"
BLOCK = 1024
SEGMENT = 256 * BLOCK
SHARD_BYTES = 32 << 20
END_ID = 2
CACHE_BYTES = 192 << 20
ENTRY_BYTES = 150
PIECE_CHARS = 1 << 20


# --- Words -------------------------------------------------------------------------------


@functools.cache
def _short_widths() -> np.ndarray:
    return np.array([n.bit_length() for n in range(1 << 16)], np.uint8)


def widths_of(ids: np.ndarray) -> np.ndarray:
    """The bits each id takes; 61 stands for all beyond 60."""
    if not ids.size or int(ids.max()) < 1 << 16:
        return _short_widths()[ids.astype(np.int64)]
    return np.searchsorted(np.uint64(1) << np.arange(61, dtype=np.uint64), ids, "right").astype(np.uint8)


def pack(ids: np.ndarray, before: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, first word of each block, exceptions)`` of unsigned ids.

    ``before``: how many exceptions the shard holds already.
    """
    blocks = -(-ids.size // BLOCK)
    grid = np.zeros((blocks, BLOCK + max(COUNTS)), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[: ids.size] = ids
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    sizes = np.minimum(BLOCK, ids.size - BLOCK * np.arange(blocks))
    widths = widths_of(grid)

    # At every id, the selector that takes most of those from there on.
    chosen = np.where(widths[:, :BLOCK] > 60, 0, 1).astype(np.uint8)
    tops = {1: widths}  # greatest width of so many ids in a row
    for selector in range(2, 16):
        count = COUNTS[selector]
        half = max(n for n in tops if n < count or n == 1)
        while half * 2 < count:
            tops[half * 2] = np.maximum(tops[half][:, :-half], tops[half][:, half:])
            half *= 2
        wide = tops[half]
        top = np.maximum(wide[:, : BLOCK], wide[:, count - half : count - half + BLOCK])
        chosen[top <= BITS[selector]] = selector

    # Follow the choice through all blocks side by side.
    counts = np.array(COUNTS)
    rows, at = np.arange(blocks), np.zeros(blocks, np.int64)
    path = []
    while rows.size:
        selectors = chosen[rows, at]
        path.append((rows, at, selectors))
        at = at + counts[selectors]
        on = at < sizes[rows]
        rows, at = rows[on], at[on]
    if not path:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rows, at, selectors = (np.concatenate(x) for x in zip(*path))
    order = np.argsort(rows, kind="stable")
    rows, at, selectors = rows[order], at[order], selectors[order]
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors).tolist():
        here = np.flatnonzero(selectors == selector)
        if selector == 0:
            words[here] |= np.arange(before, before + here.size, dtype=np.uint64)
            continue
        for j in range(COUNTS[selector] if BITS[selector] else 0):
            words[here] |= grid[rows[here], at[here] + j] << np.uint64(j * BITS[selector])
    odd = selectors == 0
    return words, np.searchsorted(rows, np.arange(blocks)), grid[rows[odd], at[odd]]


def unpack(words: np.ndarray, starts: np.ndarray, exceptions: np.ndarray) -> np.ndarray:
    """The ids of whole blocks, the last one padded; ``starts`` are relative to ``words``."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS)[selectors]
    ends = np.cumsum(counts)
    block = np.searchsorted(starts, np.arange(words.size), "right") - 1
    wide = BLOCK + max(COUNTS)
    at = block * wide + (ends - counts) - (ends - counts)[starts][block]
    grid = np.zeros(starts.size * wide, np.uint64)
    for selector in np.unique(selectors).tolist():
        here = np.flatnonzero(selectors == selector)
        if selector == 0:
            grid[at[here]] = exceptions[(words[here] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        mask = np.uint64((1 << BITS[selector]) - 1)
        for j in range(COUNTS[selector] if BITS[selector] else 0):
            grid[at[here] + j] = (words[here] >> np.uint64(j * BITS[selector])) & mask
    return grid.reshape(starts.size, wide)[:, :BLOCK].ravel()


# --- Shards ------------------------------------------------------------------------------


class Shard:
    """Collects documents; packs every full segment, so it holds few plain ids."""

    def __init__(self, part: int, number: int):
        self.part, self.number = part, number
        self.docs: list[int | None] = []
        self.ends: list[int] = []
        self.words: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.exceptions: list[np.ndarray] = []
        self.open: list[np.ndarray] = []
        self.waiting = self.n_ids = self.n_words = self.n_exceptions = 0

    def add(self, doc: int | None, ids: list[np.ndarray]) -> None:
        for piece in ids:
            self.open.append(piece)
            self.waiting += piece.size
            self.n_ids += piece.size
            if self.waiting >= SEGMENT:
                self._pack(self.waiting - self.waiting % BLOCK)
        self.docs.append(doc)
        self.ends.append(self.n_ids)

    def _pack(self, size: int) -> None:
        ids = np.concatenate(self.open) if self.open else np.zeros(0, np.uint64)
        for low in range(0, size, SEGMENT):
            words, starts, odd = pack(ids[low : min(low + SEGMENT, size)].astype(np.uint64), self.n_exceptions)
            self.words.append(words)
            self.starts.append(starts + self.n_words)
            self.exceptions.append(odd)
            self.n_words += words.size
            self.n_exceptions += odd.size
        self.open, self.waiting = [ids[size:]], ids.size - size

    def to_bytes(self) -> bytes:
        self._pack(self.waiting)
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind).tobytes()
        starts = join(self.starts, "<u8")
        return b"".join(
            [
                struct.pack(HEADER, MAGIC, self.part, self.number, len(self.docs), self.n_ids, len(starts) // 8, self.n_words, self.n_exceptions),
                np.array([d or 0 for d in self.docs], "<i8").tobytes(),
                np.array([d is None for d in self.docs], "u1").tobytes(),
                np.array(self.ends, "<u8").tobytes(),
                starts,
                join(self.words, "<u8"),
                join(self.exceptions, "<u8"),
            ]
        )


class ShardView:
    """A shard's bytes as arrays; ids come by ranges of blocks."""

    def __init__(self, data: bytes):
        magic, self.part, self.number, docs, self.n_ids, blocks, words, odd = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("no shard of token ids")
        at = struct.calcsize(HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", docs), take("u1", docs)
        self.docs = [None if gone else d for d, gone in zip(ids.tolist(), null.tolist())]
        self.ends = take("<u8", docs).astype(np.int64)
        self.starts = take("<u8", blocks).astype(np.int64)
        self.words, self.exceptions = take("<u8", words), take("<u8", odd)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``last``, ``last`` not included."""
        if first >= last:
            return np.zeros(0, np.uint64)
        low = int(self.starts[first])
        high = int(self.starts[last]) if last < self.starts.size else self.words.size
        ids = unpack(self.words[low:high], self.starts[first:last] - low, self.exceptions)
        return ids[: self.n_ids - first * BLOCK]

    def documents(self):
        """``(doc_id, start in the shard, pieces of ids)``, segment by segment."""
        step = SEGMENT // BLOCK
        at, base, ids, begin = 0, 0, self.blocks(0, min(step, self.starts.size)), 0
        for doc, end in zip(self.docs, self.ends.tolist()):
            pieces, begin = [], at
            while at < end:
                if at >= base + ids.size:
                    base += ids.size
                    first = base // BLOCK
                    ids = self.blocks(first, min(first + step, self.starts.size))
                till = min(end, base + ids.size)
                pieces.append(ids[at - base : till - base])
                at = till
            yield doc, begin, pieces


# --- Ids of texts ------------------------------------------------------------------------


class Remembered(dict):
    """Ids by chunk; asked for chunks that it lacks, it gives none and notes them."""

    def __init__(self):
        self.lacking: set[str] = set()

    def __missing__(self, chunk: str) -> bytes:
        self.lacking.add(chunk)
        return b""


class ChunkIds:
    """Ids of texts by the library, each blank-separated chunk asked for once while remembered.

    Nothing in the file's normaliser or splitter reaches across white space, and its special
    strings hold none.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self._forget()

    def _forget(self) -> None:
        self.known, self.marks, self.size = Remembered(), {}, 0

    def _word(self, word: str) -> bytes:
        """The ids of a normalised word of byte symbols."""
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def _learn(self, chunks: set[str]) -> None:
        known, marks, match = self.known, self.marks, PLAIN.fullmatch
        before, size = len(known) + len(marks), 0
        for chunk in chunks:
            end = None
            if chunk.isascii() and chunk.isalpha():
                word = chunk.lower()
            elif plain := match(chunk):  # what the library's normaliser and splitter make of the usual chunk
                word, end = plain.groups()
                word = word.lower()
            else:
                known[chunk] = ids = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
                size += 4 * len(chunk) + len(ids)
                continue
            ids = known.get(word)  # a word in lower case is a chunk too
            if ids is None:
                symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_SYMBOLS)
                ids = known[word] = self._word(symbols)
                size += len(word) + len(ids)
            if end:
                tail = marks.get(end)
                if tail is None:
                    tail = marks[end] = self._word(end)
                    size += len(end) + len(tail)
                ids += tail
            if word != chunk:
                known[chunk] = ids
                size += len(chunk) + len(ids)
        self.size += size + ENTRY_BYTES * (len(known) + len(marks) - before)

    def ids(self, text: str):
        """The ids of a text, as arrays of a bounded number of chunks."""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE_CHARS:
                # Up to a blank, which belongs to no chunk.
                gap = re.compile("[ \n]").search(text, at + PIECE_CHARS)
                end = gap.start() if gap else end
            chunks = text[at:end].replace("\n", " ").split(" ")
            at = end
            if self.size > CACHE_BYTES:
                self._forget()
            known = self.known
            found = b"".join(map(known.__getitem__, chunks))
            if known.lacking:
                self._learn(known.lacking)
                known.lacking = set()
                found = b"".join(map(known.__getitem__, chunks))
            yield np.frombuffer(found, np.uint32)


# --- Jobs --------------------------------------------------------------------------------


def write_ids(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of ``docs (doc_id, text)``, each followed by ``end_id``, as shards below ``path``.

    Documents are dealt out by ranges of ids and sorted, so parts and shards follow ascending
    ids, null ones first; rows of one id are ordered by the hash of their text, and many of
    them may be spread over parts.  A shard is closed at ``SHARD_BYTES``; a longer document makes
    its shard longer.  The text moves once; nothing but the open segment is held as plain ids.
    """

    def run(batches):
        source = tokenizer_path
        if source is None:
            import public_tokenizers

            source = public_tokenizers.path("word_bpe_49k.json")
        coder = kept_by_worker(("ids", source), lambda: ChunkIds(source))
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        shard = Shard(part, 0)

        def out(done: Shard):
            return pa.RecordBatch.from_arrays([pa.array([done.to_bytes()], pa.binary())], ["shard"])

        for b in batches:
            for doc, value in zip(b.column(0).to_pylist(), b.column(1)):
                if shard.n_words * 8 >= SHARD_BYTES:
                    yield out(shard)
                    shard = Shard(part, shard.number + 1)
                shard.add(doc, [*coder.ids(value.as_py()), end])
        if shard.docs:
            yield out(shard)

    texts = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64("text").alias("mark"))
    # The row's place only deals out repeated rows; equal rows get equal results.
    texts = texts.withColumn("spread", F.monotonically_increasing_id())
    ordered = texts.repartitionByRange("doc_id", "mark", "spread").sortWithinPartitions("doc_id", "mark", "spread")
    shards = ordered.select("doc_id", "text").mapInArrow(run, "shard binary")
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_ids(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``part, shard, doc_id, begin, n_tokens, ids_crc32`` from the files, and ``ids`` on demand.

    ``begin`` counts the ids before the document's in its shard.
    """
    fields = "part long, shard long, doc_id long, begin long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def run(batches):
        for b in batches:
            for data in b.column(0):
                view = ShardView(data.as_buffer())
                rows: list[tuple] = []
                held = 0

                def out():
                    cols = list(zip(*rows)) or [[]] * (6 + ids)
                    types = [pa.int64()] * 6 + [pa.list_(pa.int64())] * ids
                    names = ["part", "shard", "doc_id", "begin", "n_tokens", "ids_crc32", "ids"]
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[: len(types)])

                for doc, begin, pieces in view.documents():
                    crc = n = 0
                    for p in pieces:
                        crc = zlib.crc32(p.astype("<u4").tobytes(), crc)
                        n += p.size
                    row = (view.part, view.number, doc, begin, n, crc)
                    rows.append(row + (np.concatenate(pieces).astype(np.int64),) if ids else row)
                    held += 1 + n * ids
                    if held >= SEGMENT:
                        yield out()
                        rows, held = [], 0
                yield out()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, fields)


def shard_starts(rows: DataFrame) -> DataFrame:
    """``part, shard, before``: the ids in all earlier shards.

    Only parts, one row for each task that wrote, meet in one window.
    """
    sums = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    parts = sums.groupBy(F.col("part").alias("_part")).agg(F.sum("n").alias("n"))
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("outside"))
    joined = inside.join(parts, inside["part"] == parts["_part"])
    return joined.select(F.col("part").alias("_part"), F.col("shard").alias("_shard"), (F.col("inside") + F.col("outside")).alias("before"))


def token_files(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None) -> DataFrame:
    """Writes the ids of all texts and reads them back: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before; ``n_tokens`` and the checksum (ids as
    little-endian 32-bit integers) include the end id.  ``path``: where the files go; by
    default a folder of their own below the shared one.  A null or blank text has the end id only; a null
    id comes first and keeps its row; repeated rows each have their ids in the files, by the
    hash of the text where ids are equal; an empty table writes no shard; further columns are
    ignored; texts of any length are coded whole.
    """
    spark = docs.sparkSession
    path = path or stage_path(spark, "token-ids")
    write_ids(docs, path, tokenizer_path)
    rows = staged(read_ids(spark, path), "token-rows")
    starts = shard_starts(rows)
    meet = (rows["part"] == starts["_part"]) & (rows["shard"] == starts["_shard"])
    return rows.join(starts, meet).select("doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
