"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import written
from noticemill.operators.skew import skew_join


# Edges in one written part: small tables go into few files.
PART_EDGES = 250_000


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest node near it.

    A node may have a third of all edges as their smaller end, so its rows are spread.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_rows"))
    least = written(least.coalesce(parts), "least")
    near = skew_join(both, least.select("u", "m"), ["u"], "inner", ["v"], least.select("u", "_rows"))
    return near.filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), sums).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node of an edge (u, v) but the roots.

    Each round writes its edges to the shared folder, so a lost executor costs one round at
    most; the number of rounds grows with the logarithm of the longest path. Edges of a
    node to itself say nothing.
    """
    edges = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        # a round leaves no more edges than there were
        parts = 1 + before[0] // PART_EDGES
        edges = written(_small_star(_large_star(edges, parts)).coalesce(parts), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
