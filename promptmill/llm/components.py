"""Connected components over an edge table, by repeated shuffles of narrow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.operators.skew import attach
from promptmill.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for nodes with an edge.

    ``edges`` has long columns ``a`` and ``b``. Alternates the large-star and small-star steps until
    nothing changes: each links the neighbours of a node to their smallest, so the number of rounds
    grows with the logarithm of the longest path. Every step is a combinable minimum per node and
    a join on the node, salted so that a node of many neighbours is split.
    """
    edges = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (
            attach(both, smallest, ["a"], F.col("b"))
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            attach(large, lowest, ["a"], F.col("b"))
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.*")
            .filter("a <> b")
            .distinct()
        )
        following = materialise(small)
        state = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        if edges.agg(*state).first() == following.agg(*state).first():
            break
        edges = following
    low = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return low.unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))
