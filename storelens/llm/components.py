"""Connected components of a written edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.session import staged


def _lowest(edges: DataFrame, label: str) -> DataFrame:
    """Per node its lowest neighbour. Written, so that the join with a hub's many edges can be split."""
    return staged(edges.groupBy("u").agg(F.min("v").alias("low")), label)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the lowest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both, "large-star")
    linked = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
    return linked.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the lowest of them; edges run from high to low."""
    low = _lowest(edges, "small-star")
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge, roots included; the root is the lowest node of the component.

    ``edges`` has columns ``u, v`` of one ordered type. Each round is written to the shared folder and only a count
    and a checksum come to the driver. The number of rounds grows with the logarithm of the longest chain.
    """
    high_low = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = staged(high_low, "edges")
    mark = _mark(now)
    while mark[0]:
        now = staged(_small_star(staged(_large_star(now), "large-stars")), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
