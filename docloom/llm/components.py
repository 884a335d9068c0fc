"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import staged


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node.

    Each round points nodes at the smallest neighbour known, first the larger ones and then
    the smaller, until the edges form stars; the number of rounds grows with the logarithm
    of the longest chain.  A node with many neighbours is one small row per neighbour, met
    by a join on its minimum, so no group is gathered.
    """
    now = staged(_ordered(edges), label)
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            break
        before = mark
        now = staged(_small_star(_large_star(now)), label)
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    own = now.select(F.col("a").alias("node"), F.col("a").alias("root"))
    return roots.unionAll(own).distinct()


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges as (smaller, larger), once each, without loops."""
    return edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node's surroundings."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    return _ordered(both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    return _ordered(
        moved.select(F.col("m").alias("a"), F.col("a").alias("b")).unionAll(
            least.select(F.col("m").alias("a"), "b")
        )
    )
