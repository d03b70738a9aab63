"""Connected components of a graph given as edges, by alternating large and small stars.

Every round is two aggregations and two joins over the edges; no neighbourhood is gathered in one task. The edges of a
round are written to the shared folder, so a lost executor costs at most one round. A hub with very many edges is a
skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect the larger neighbours of every vertex to its smallest neighbour (or to itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect the smaller neighbours of every vertex, and the vertex, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rewired = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return rewired.unionByName(own).filter("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root``: for every vertex of ``edges`` (a, b: long) that is not the smallest of its component, the
    smallest one. Self links and repeated edges do not matter; no edges give no rows."""
    current = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = _digest(current)
    while before[0]:
        current = stored(_small_star(_large_star(current)), "edges")
        after = _digest(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
