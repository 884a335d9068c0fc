"""Token counts: pieces counted once per distinct pre-token, joined to documents' frequencies."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import staged, text_or_empty

BLANK = "▁"
# At most so many of the most frequent pre-tokens, whose counts every task holds; all
# others are joined.
COMMON = 300_000
FLUSH = 400_000
# A pre-token starts where a blank follows anything else, and around line ends: in this
# vocabulary no piece has a blank after another character, and none holds a line end.
LINE = "\n"


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, blanks as U+2581, a blank put before the text.

    Line ends are pre-tokens of their own.
    """
    if not text:
        return []
    text = BLANK + text.replace(" ", BLANK)
    out: list[str] = []
    for i, line in enumerate(text.split(LINE)):
        if i:
            out.append(LINE)
        if BLANK + BLANK in line:
            out += re.findall(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+", line)
        else:
            parts = line.split(BLANK)
            if parts[0]:
                out.append(parts[0])
            out += [BLANK + p for p in parts[1:]]
    return out


def piece_counter(path: str | None):
    """Counts the pieces of pre-tokens with the sentencepiece library."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    # After a line end a pre-token stands without the blank that the library puts in front.
    lead = len(model.encode(LINE))

    def count(tokens: list[str]) -> list[int]:
        coded = model.encode([LINE + t for t in tokens], num_threads=1)
        return [len(c) - lead if t != LINE else lead - 1 for t, c in zip(tokens, coded)]

    return count


def _frequencies(frames):
    """How often each pre-token occurs, summed over as much of a task as memory allows."""
    from collections import Counter

    seen: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["token", "n"],
        )

    for batch in frames:
        for value in batch.column(0):
            seen.update(pre_tokens(value.as_py()))
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
    yield out()


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    A null text counts as empty and has no tokens.  Repeated rows and
    null ids each keep their row; further columns are ignored.  The pieces of the ``COMMON`` most frequent pre-tokens go to every task (a
    table of that many rows at most); those of all others meet the documents in a join.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    distinct = (
        texts.select("text")
        .mapInArrow(_frequencies, "token string, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )

    def count(batches):
        counter = piece_counter(model_path)
        for b in batches:
            pieces = counter(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(pieces, pa.int64())], ["token", "n", "pieces"]
            )

    pieces = staged(distinct.mapInArrow(count, "token string, n long, pieces long"), "token-pieces")
    common = docs.sparkSession.sparkContext.broadcast(_most_frequent(pieces))

    def tally(batches):
        from collections import Counter

        for b in batches:
            parts, tokens, times = [], [], []
            known = common.value
            get = known.get
            for value in b.column(2):
                here = pre_tokens(value.as_py())
                found = [get(t, 0) for t in here]
                rest = Counter(t for t, n in zip(here, found) if not n)
                parts.append(sum(found))
                tokens.append(list(rest.keys()))
                times.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(parts, pa.int64()),
                    pa.array(tokens, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_bytes", "n_common", "tokens", "times"],
            )

    tallied = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    tallied = staged(  # written once, so the row numbers stay as they are
        tallied.mapInArrow(tally, TALLY_FIELDS).withColumn("row", F.monotonically_increasing_id()),
        "token-tallies",
    )
    rest = (
        tallied.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t"))
        .select("row", F.col("t.tokens").alias("token"), F.col("t.times").alias("times"))
        .join(pieces.select("token", "pieces"), "token")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("pieces")).alias("n_rest"))
    )
    n = F.col("n_common") + F.coalesce("n_rest", F.lit(0))
    return tallied.select("row", "doc_id", "n_bytes", "n_common").join(rest, "row", "left").select(
        "doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")
    )


TALLY_FIELDS = "doc_id long, n_bytes long, n_common long, tokens array<string>, times array<int>"


def _most_frequent(pieces: DataFrame) -> dict[str, int]:
    """Pieces of the pre-tokens that occur often enough for at most ``COMMON`` to do so."""
    counts = pieces.groupBy("n").count().orderBy(F.desc("n")).limit(COMMON).collect()
    total, least = 0, None
    for n, tokens in counts:
        total += tokens
        if total > COMMON:
            break
        least = n
    if least is None:
        return {}
    return {t: p for t, p in pieces.filter(F.col("n") >= least).select("token", "pieces").collect()}
