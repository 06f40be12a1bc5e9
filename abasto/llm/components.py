"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abasto.llm.common import drop_staged, stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the smallest of them. Edges go from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    rest = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.union(rest).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum((F.xxhash64("a", "b") % (1 << 40)).cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has an edge; a root is not listed itself.

    ``edges`` has two bigint columns ``a``, ``b``. Every round is a staged table; the rounds grow with the logarithm of
    the longest chain. A node with many neighbours is aggregated before it is shuffled and its join can be split.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    now = stage(pairs)
    state = _state(now)
    while state[0]:
        after = stage(_small_star(_large_star(now)))
        drop_staged(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
