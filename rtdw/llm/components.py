"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): of each node of the edges (a, b), the least node that it reaches.

    Alternating star steps: every node hangs its larger neighbours, then its smaller ones,
    on the least neighbour. Each round is written to a table; rounds end when the edges no
    longer change, after about as many rounds as the logarithm of the longest path. No node's
    neighbours are gathered in one row.
    """
    now = stored(_ordered(edges), "component-edges")
    before = _sum(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = _ordered(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        now = stored(_ordered(small), "component-edges")
        after = _sum(now)
        if after == before:
            break
        before = after
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, larger end first, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _sum(edges: DataFrame) -> tuple:
    """Two equal edge tables have equal sums."""
    key = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(key), F.sum(F.shiftright(key, 8))).first())
