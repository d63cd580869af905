"""Connected components of an edge table by alternating large-star and small-star steps.

Defined results: an edge with a null end is no edge; an edge from a node to itself gives no row; repeated
edges, in either direction, count once; no edges give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    to_least = F.inline(F.array(*(F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b"))))
    return down.join(least, "a").select(to_least).where("a > b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is only ever the smaller end, or only once the larger one: a turn changes nothing then."""
    ends = F.inline(F.array(*(F.struct(F.col(c).alias("node"), F.lit(up).alias("up")) for c, up in (("a", 1), ("b", 0)))))
    nodes = edges.select(ends).groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("ends"))
    return nodes.where("up > 1 OR up = 1 AND ends > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Every node of the edges ``(a, b)``, as ``node``, with the smallest node it reaches, as ``component``."""
    edges = edges.where("a <> b").select("a", "b")  # a null is unequal to nothing
    while True:
        # each kind of step is stored, so that none is computed twice in one plan
        edges = stored(_small_star(stored(_large_star(edges), "stars")), "stars")
        if _are_stars(edges):
            break
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
