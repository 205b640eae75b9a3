"""Connected components of an edge table by alternating star contraction; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) for each node that has an edge to another one; component is the smallest node reachable.

    Nulls and loops are ignored, repeated edges count once, no edges give no rows. Each round links every neighbour to
    the smallest one seen (large star: of larger neighbours; small star: of smaller ones). A node's minimum is a
    pre-aggregated groupBy, so a node with a third of all edges is no hot task; the minima are dealt anew before they
    are joined back to the edges, so that adaptive execution can split that join. It ends when each node hangs on a root: no node is both a child and a parent.
    """
    pairs = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where(f"{a} is not null and {b} is not null and lo < hi")
    pairs = written(pairs.distinct())
    for _ in range(max_rounds):
        both = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).hint("rebalance")
        # large star: each larger neighbour of u hangs on the smallest of u and its neighbours
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        # small star: u and its smaller neighbours hang on the smallest of them
        parent = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m")).hint("rebalance")
        small = large.withColumnRenamed("hi", "u").join(parent, "u")
        small = small.select("m", F.explode(F.array("lo", "u")).alias("hi")).where("m < hi").select(F.col("m").alias("lo"), "hi").distinct()
        before, pairs = pairs, written(small)
        discard(before)
        ends = pairs.select(F.col("lo").alias("n"), F.lit(1).alias("parent"), F.lit(0).alias("child")).union(pairs.select("hi", F.lit(0), F.lit(1)))
        ends = ends.groupBy("n").agg(F.max("parent").alias("parent"), F.sum("child").alias("children"))
        if ends.where("children > 1 or parent = 1 and children > 0").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.union(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
