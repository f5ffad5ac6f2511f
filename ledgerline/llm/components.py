"""Connected components of an edge table, in joins and aggregates only.

Alternating large-star and small-star steps (Kiveris et al., 2014): each node's
smallest neighbour is an aggregate with map-side combine, and edges are moved by
a join with that (staged) table, so a hot node's edges are split by the skew join
and no neighbour list is ever gathered. Each step is staged, by as many tasks as its
edges need; no lineage grows. The aggregate also shows when only stars are left: it is
the result then, and no further round is made to confirm it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


#: bytes of an edge, or of a node with its neighbours
EDGE = 16
NEAR = 24


def connected(edges: DataFrame, max_rounds: int = 100, most: int | None = None) -> DataFrame:
    """edges: two long columns a, b; most: how many there can be, if known. Returns node, root
    (smallest node of its component) for every node that has an edge to another node, roots included."""
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = staged(current, "edges", most and most * EDGE)
    for _ in range(max_rounds):
        n = current.count()
        both = current.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(current.select(F.col("v").alias("a"), F.col("u").alias("b")))
        ends = both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        # of a star, each node has larger neighbours only, or a single smaller one
        ends = ends.select("a", F.least("a", "low").alias("m"), F.expr("low < a AND high <> low").alias("open"))
        least = staged(ends, "large-star", 2 * n * NEAR)
        if not least.agg(F.bool_or("open")).first()[0]:
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        least = least.drop("open")
        # a round never adds edges
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "edges", n * EDGE)
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small-star", n * EDGE)
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = staged(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges", n * EDGE)
    raise RuntimeError("components did not settle")
