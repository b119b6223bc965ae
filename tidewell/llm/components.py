"""Connected components of an edge list, by repeated contraction to stars.

Every round replaces the edges of a node by edges to its smallest neighbour, first for its larger and then for its smaller
neighbours. The rounds needed grow with the logarithm of the longest chain. Only narrow rows are shuffled, minima are combined
before the shuffle, and each round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("node").agg(F.min("other").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    low = _nearest(both).select("node", F.least("low", "node").alias("low"))
    moved = both.join(low, "node").where("other > node")
    return moved.select(F.col("other").alias("node"), F.col("low").alias("other"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = _nearest(edges)
    moved = edges.join(low, "node")
    return (
        moved.select(F.col("other").alias("node"), F.col("low").alias("other"))
        .unionByName(low.select("node", F.col("low").alias("other")))
        .where("node <> other")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of ``edges`` (node long, other long) that is not itself the smallest of its component."""
    up = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    now = materialize(up.where("node <> other").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.expr("sum(cast(xxhash64(node, other) as decimal(38,0)))")).first()
        if seen == mark or seen[0] == 0:
            return now.select("node", F.col("other").alias("root"))
        mark = seen
        now = materialize(_small_star(_large_star(now)), "edges")
