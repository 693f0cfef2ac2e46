"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(apart(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(apart(least), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (integers) but the roots themselves.

    The root is the smallest node of the component. Each round is written to a table; a round of stars
    alone, which repeats itself, is the last. Nothing but the count and checksum of a round reaches the driver.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before, turn = None, 0
    while True:
        table = scratch.write(now, f"{name}-{turn}")
        mark = tuple(table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if turn:
            scratch.drop(f"{name}-{turn - 1}")
        if mark == before or not mark[0]:
            return table.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, turn = mark, turn + 1
        now = _small(_large(table).distinct()).distinct()
