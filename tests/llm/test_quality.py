"""The quality classifier learns from all labelled rows."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F


def test_quality_learns_from_every_row(spark):
    """A kind of bad row that is rare, and late by any hash order a sample could follow."""
    from docloom.llm.common import held_out
    from docloom.llm.quality import score_quality

    r = random.Random(3)
    order = F.xxhash64("doc_id", F.lit("quality"))
    ids = [x.doc_id for x in spark.range(22_000).withColumnRenamed("id", "doc_id").filter(~held_out()).orderBy(order).collect()]
    rows, late = [], []
    for at, i in enumerate(ids):
        words = [r.choice(("aa", "bbb", "cccc", "ddddd")) for _ in range(r.randint(5, 9))]
        if at >= 14_000:  # half of the rows before are bad
            words[1] += "~"
            late.append(i)
        elif at % 2:
            words[1] += "12"
        rows.append((i, " ".join(words), 0 if at >= 14_000 or at % 2 else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    found = score_quality(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    wrong = found.join(docs, "doc_id").filter("predicted != quality")
    assert late and wrong.count() <= len(rows) // 100


def test_pairs_cover_every_row(spark):
    """All rows of both labels are in a bucket that holds the other label too, if one label is rare as well."""
    from docloom.llm.quality import FEATURES, buckets, pair_sums

    rows = [(i, [float(i)] * FEATURES, float(i % 100 > 0)) for i in range(4000)]
    known = spark.createDataFrame(rows, "doc_id long, features array<float>, quality double")
    dealt = buckets(known, 3960, 40)
    once = dealt.filter("copy = 0")
    assert once.count() == 4000 and once.select("features").distinct().count() == 4000
    kinds = dealt.groupBy("bucket").agg(F.count_distinct("quality").alias("n"))
    assert kinds.filter("n != 2").count() == 0

    g = np.random.default_rng(1)
    good, bad, w = g.normal(size=(7, 3)), g.normal(size=(5, 3)), g.normal(size=3)
    d = (good[:, None] - bad[None]).reshape(-1, 3)
    p = 1 / (1 + np.exp(d @ w))
    want = np.concatenate([[35, np.log1p(np.exp(-(d @ w))).sum()], -(p @ d), ((d.T * (p * (1 - p))) @ d).ravel()])
    assert np.allclose(pair_sums(good, bad, w), want)
