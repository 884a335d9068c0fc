"""Secret scans with linked multipart credentials.  DataFrame functions only.

Strong patterns give the base spans.  Weak parts (bare high-entropy strings, account names,
endpoints) are reported only where a complementary part lies in the same scope, found by an
interval join over slim spans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import staged, text_mark, text_or_empty

# The base patterns and the least length of what must be long.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the least length of 20 as part of the pattern
HEX = r"[0-9a-f]{24,}"  # runs are maximal either way
ASSIGN_VALUE = 6
# Weak parts.
# It may follow NAME= directly, and has no greatest length.  It holds a digit and letters of
# both cases; each test stays in the run it starts, so every character is passed a fixed
# number of times however long the text is.
WEAK_SECRET = (
    r"(?<![A-Za-z0-9+/_-])"
    r"(?=[A-Za-z+/_-]*+[0-9])(?=[0-9a-z+/_-]*+[A-Z])(?=[0-9A-Z+/_-]*+[a-z])"
    r"[A-Za-z0-9+/_-]{32,}+"
)
WEAK_ID = r"""(?i)\b(?:user_?name|login|account_?id|client_?id|access_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"""\b(?:https?|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+"""

# Kind, pattern, role, base or weak; in the order of the result.
KINDS = (
    ("assign", ASSIGN, "secret", True),
    ("access", ACCESS, "id", True),
    ("hex", HEX, "secret", True),
    ("weak_secret", WEAK_SECRET, "secret", False),
    ("weak_id", WEAK_ID, "id", False),
    ("endpoint", ENDPOINT, "endpoint", False),
)
REACH = 200
SCOPE = 512


def _found(kind: str, pattern: str) -> Column:
    """Lengths of the text before each match, of the matches and of an assigned value.

    Splitting at a pattern and extracting it find the same matches, so their running sum
    gives the places.  Null without a match.
    """
    text, p = F.col("text"), F.lit(pattern)
    value = F.regexp_extract_all(text, p, F.lit(2 if kind == "assign" else 0))
    found = F.struct(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gaps"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.char_length).alias("sizes"),
        F.transform(value, F.char_length).alias("values"),
    )
    here = text.rlike(pattern)
    return F.when(F.contains(text, F.lit("AKIA")) & here if kind == "access" else here, found)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, mark`` and a column of lengths per kind, one row per row of ``docs``."""
    texts = docs.select("doc_id", text_mark().alias("mark"), text_or_empty().alias("text"))
    return texts.select("doc_id", "mark", *[_found(k, p).alias(k) for k, p, _, _ in KINDS])


def spans(scanned: DataFrame) -> DataFrame:
    """``doc_id, mark, kind, start, end`` in code points, end exclusive."""
    parts = []
    for order, (kind, _, role, base) in enumerate(KINDS):
        zipped = F.arrays_zip(f"{kind}.gaps", f"{kind}.sizes", f"{kind}.values")
        parts.append(
            scanned.filter(F.col(kind).isNotNull()).select(
                "doc_id",
                "mark",
                F.lit(order).alias("kind"),
                F.lit(role).alias("role"),
                F.lit(base).alias("base"),
                F.posexplode(zipped).alias("nth", "m"),
            )
        )
    rows = reduce(DataFrame.unionAll, parts).filter("m.sizes is not null")  # the last gap has no match
    # Repeated rows of a document say the same.
    rows = rows.select(
        "doc_id", "mark", "kind", "role", "base", "nth",
        F.col("m.gaps").alias("gap"), F.col("m.sizes").alias("size"), F.col("m.values").alias("value"),
    ).distinct()
    upto = Window.partitionBy("doc_id", "mark", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    return placed.filter((F.col("kind") != 0) | (F.col("value") >= ASSIGN_VALUE)).select(
        "doc_id", "mark", "kind", "role", "base", "start", "end"
    )


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak spans with a complementary part at most ``reach`` code points away.

    A weak secret needs an identifier or endpoint, an identifier a secret, and an endpoint
    a secret.  Weak parts inside a base span are that span's own.  Scopes are buckets of
    text, and a weak span looks into each its reach touches, so a long document's parts
    meet only their neighbours.
    """
    near = [c - F.lit(reach) if s < 0 else c + F.lit(reach) for c, s in ((F.col("start"), -1), (F.col("end"), 1))]
    low, high = (F.floor(c / SCOPE) for c in near)
    weak = found.filter("not base").withColumn("scope", F.explode(F.sequence(low, high)))
    parts = found.select(
        *[F.col(c).alias(f"_{c}") for c in ("doc_id", "mark", "role", "base", "start", "end")],
        F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor(F.col("end") / SCOPE))).alias("_scope"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("mark") == F.col("_mark"))
        & (F.col("scope") == F.col("_scope"))
    )
    touch = (F.col("_start") < F.col("end") + reach) & (F.col("_end") > F.col("start") - reach)
    inside = same & F.col("_base") & (F.col("_start") < F.col("end")) & (F.col("_end") > F.col("start"))
    fits = F.when(F.col("role") == "secret", F.col("_role").isin("id", "endpoint")).otherwise(
        F.col("_role") == "secret"
    )
    owned = weak.join(parts, inside, "left_semi").drop("scope").distinct()
    wanted = weak.join(parts, same & touch & fits, "left_semi").drop("scope").distinct()
    keys = [wanted[c].eqNullSafe(owned[c]) for c in ("doc_id", "mark", "kind", "start")]
    return wanted.join(owned, reduce(Column.__and__, keys), "left_anti")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``.

    A null text holds nothing.  Rows are told apart by id and text: repeated rows each get
    the same result, and a null id keeps its row.  Further columns are ignored.  Long texts
    are read whole, in time that grows with their length.
    """
    scanned = staged(scan(docs), "secret-lengths")
    found = staged(spans(scanned), "secret-spans")
    every = found.filter("base").unionByName(linked(found))
    names = F.array(*[F.lit(k) for k, *_ in KINDS])
    label = F.concat_ws(":", F.get(names, F.col("kind")), "start", "end")
    item = F.struct("start", "kind", label.alias("label"))
    per = every.groupBy("doc_id", "mark").agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, (k, _, _, base) in enumerate(KINDS) if base],
        F.sort_array(F.collect_list(F.when(F.col("base"), item))).alias("strong"),
        F.sort_array(F.collect_list(item)).alias("every"),
    )
    per = per.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    rows = scanned.select("doc_id", "mark")
    joined = rows.join(per, rows["doc_id"].eqNullSafe(per["_id"]) & (rows["mark"] == per["_mark"]), "left")
    text = lambda c: F.coalesce(F.array_join(F.col(f"{c}.label"), ","), F.lit(""))
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k, _, _, base in KINDS if base],
        F.sha2(text("strong").cast("binary"), 256).alias("base_sha256"),
        text("every").alias("spans"),
    )
