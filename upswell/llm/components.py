"""Connected components of a stored edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell.llm.common import store

#: Rounds halve the depth of every tree; 2**60 nodes in a chain need no more.
ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node of the component.

    Alternating large-star and small-star rounds: every node tells its larger neighbours, then its
    smaller ones, the smallest node it knows. Only minima are gathered per node, so a node
    with very many neighbours costs one row per task, and joins on such a node can be split.
    """
    now = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(ROUNDS):
        # large star: larger neighbours of a node get its minimum
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # an edge (a > b) is seen from b: a gets the minimum that b knows
        large = now.join(least, now["b"] == least["u"]).select("a", F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: a node and its smaller neighbours get the node's minimum
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(low, large["a"] == low["u"])
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = store(small.distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components not settled after {ROUNDS} rounds")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
