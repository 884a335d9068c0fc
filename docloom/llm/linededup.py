"""Line dedup: range-partitioned line hashes, streamed first occurrences, keep bitmaps.

DataFrame functions only.  A line's key is the line stripped of ASCII white space with A-Z
lower-cased; keys travel as two independent 64-bit hashes, texts stay where they are until
the bitmaps are applied.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import staged, text_mark, text_or_empty

MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
# Ids of one block and key are streamed together; a frequent key spans many blocks.
BLOCK_IDS = 4096


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    cut = F.btrim(line, F.lit(BLANKS))
    # lower() also folds letters beyond ASCII, so it serves lines without such letters only.
    plain = F.octet_length(cut) == F.char_length(cut)
    return F.when(plain, F.lower(cut)).otherwise(
        F.translate(cut, string.ascii_uppercase, string.ascii_lowercase)
    )


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, mark, pos, h1, h2`` of every line long enough, one row per line."""
    rows = docs.select(
        "doc_id", text_mark().alias("mark"), F.posexplode(lines_of(text_or_empty())).alias("pos", "line")
    )
    rows = rows.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    return rows.select(
        "doc_id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(41), "key").alias("h2")
    )


def repeated_keys(occ: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys found in at least ``min_docs`` documents, with the largest id that holds each.

    Rows are dealt out by ranges of (key, block of ids) and sorted by document and position
    inside; the stream marks the first line of each document and sums up every block, and
    one row per key and block goes on.  So no task meets all rows of a frequent key.
    """
    block = F.floor(F.col("doc_id") / BLOCK_IDS)
    ranged = occ.select("h1", "h2", block.alias("block"), "doc_id", "pos").repartitionByRange(
        "h1", "h2", "block"
    )
    order = Window.partitionBy("h1", "h2", "block").orderBy(F.desc_nulls_last("doc_id"), "pos")
    before = F.lag("doc_id").over(order)
    rank = F.row_number().over(order)
    first = (rank == 1) | ~F.col("doc_id").eqNullSafe(before)
    runs = ranged.withColumn("first", first).filter("first")
    return (
        runs.groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, mark, n_dropped, keep`` of the documents that lose lines.

    ``keep`` is a sparse bitmap: ``(word, mask)`` by word, bit ``i`` of word ``w`` standing
    for line ``64 w + i``; absent words, and documents without a row, keep every line.
    """
    occ = staged(occurrences(docs, min_chars), "line-keys")
    # Written, so that both sides of the join are plain exchanges and a frequent key's can be split.
    repeated = staged(repeated_keys(occ, min_docs), "line-repeated")
    gone = occ.join(repeated, ["h1", "h2"]).filter(
        ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    )
    words = gone.groupBy("doc_id", "mark", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("mask")
    )
    return words.groupBy("doc_id", "mark").agg(
        F.sum(F.bit_count("mask")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("mask").alias("mask")))).alias("keep"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``_n_lines, _n_dropped, _kept`` (the text left) and ``_map_keep`` (its bitmap,
    null where every line stays) beside its columns."""
    maps = bitmaps.select(
        F.col("doc_id").alias("_map_id"),
        F.col("mark").alias("_map_mark"),
        F.col("n_dropped").alias("_map_dropped"),
        F.col("keep").alias("_map_keep"),
    ).hint("shuffle_hash")
    same = docs["doc_id"].eqNullSafe(maps["_map_id"]) & (F.xxhash64(docs["text"]) == maps["_map_mark"])
    dense = F.expr(
        "transform(sequence(0, array_max(_map_keep).word),"
        " w -> coalesce(try_element_at(map_from_entries(_map_keep), w), -1L))"
    )
    joined = docs.join(maps, same, "left").withColumns(
        {"_text": text_or_empty(), "_dense": F.when(F.col("_map_keep").isNotNull(), dense)}
    )
    kept = F.filter(
        lines_of(F.col("_text")),
        lambda _, i: F.getbit(
            F.coalesce(F.get("_dense", F.shiftright(i, 6)), F.lit(-1).cast("long")), i.bitwiseAND(63)
        )
        == 1,
    )
    n_lines = F.char_length("_text") - F.char_length(F.replace("_text", F.lit("\n"))) + 1
    return joined.withColumns(
        {
            "_n_lines": n_lines.cast("long"),
            "_n_dropped": F.coalesce("_map_dropped", F.lit(0)).cast("long"),
            "_kept": F.when(F.col("_map_keep").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")),
        }
    ).select(*docs.columns, "_n_lines", "_n_dropped", "_kept", "_map_keep")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that are left and, where there is one, their ``n_chars``.

    Every row and column stays; a null text stays null.
    """
    done = apply_bitmaps(docs, keep_bitmaps(docs.select("doc_id", "text")))
    changed = {"text": F.when(F.col("text").isNotNull(), F.col("_kept"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(
            F.col("_n_dropped") > 0, F.char_length("_kept").cast(kind)
        ).otherwise(F.col("n_chars"))
    return done.withColumns(changed).select(*docs.columns)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256, keep`` for every row of ``docs``.

    ``keep`` writes the sparse bitmap as ``word:mask`` with the mask in hex, comma-joined by
    word; it is empty where every line stays.

    A key in at least ``min_docs`` ids keeps its lines in the largest of them only.  A null
    text is one empty line.  Rows of one id count as one document, and each loses the same
    lines; rows without id count together as one document below all others.  Keys shorter
    than ``min_chars`` always stay.  Further columns are ignored.
    """
    slim = docs.select("doc_id", "text")
    done = apply_bitmaps(slim, keep_bitmaps(slim, min_chars, min_docs))
    label = lambda w: F.concat_ws(":", w["word"], F.lpad(F.lower(F.hex(w["mask"])), 16, "0"))
    return done.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"),
        F.coalesce(F.array_join(F.transform("_map_keep", label), ","), F.lit("")).alias("keep"),
    )


SQL = """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(
    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
), words AS (
  SELECT doc_id, pos // 64 AS word, ~bit_or(1::UBIGINT << (pos % 64)::UBIGINT) AS mask
  FROM judged WHERE gone GROUP BY ALL
), maps AS (
  SELECT doc_id, string_agg(word || ':' || lower(lpad(to_hex(mask), 16, '0')), ',' ORDER BY word) AS keep
  FROM words GROUP BY doc_id
), done AS (
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
)
SELECT d.*, coalesce(m.keep, '') AS keep FROM done d LEFT JOIN maps m USING (doc_id)
"""
