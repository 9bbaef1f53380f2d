"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.session import saved

MOST_ROUNDS = 100


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``u, m``: the smallest of a node and its neighbours. Written out, so that the join with
    it shuffles both sides plainly and AQE can split a node with very many edges."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return saved(least, "least-neighbour")


def _star(pairs: DataFrame) -> DataFrame:
    least = _least_neighbour(pairs)
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _star(both).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    linked = _star(down)
    to_least = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = linked.select("u", F.col("m").alias("v"))
    return to_least.unionByName(own).filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.xxhash64("v", "u") % 65521)
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link to another; root is its component's least.

    ``edges`` has columns ``u`` and ``v`` of one orderable type, in any direction, repeated or
    not; loops are ignored. The two steps are repeated until nothing changes, which takes a
    number of rounds that grows with the logarithm of the largest component's size.
    """
    current = saved(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = _mark(current)
    if before[0]:
        for _ in range(MOST_ROUNDS):
            current = saved(_small(saved(_large(current), "large-star")), "small-star")
            after = _mark(current)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    own = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        own.withColumn("root", F.col("node"))
    )
