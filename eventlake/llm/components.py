"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included. Written out, so that a join with it can
    split the rows of a hub, which Spark does not do right behind an aggregation."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return stored(least.select("u", F.least("u", "m").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    count, total = edges.agg(F.count("*"), mark).first()
    return count, total


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of the edges (u, v): the smallest id it can reach.

    Loops and repeated edges are ignored; rows with a null end are dropped; an empty edge table
    gives no rows. Nodes without edges are not listed: they are their own component. Every round
    is two joins over written tables; the driver sees a count and a sum of hashes per round."""
    edges = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(stored(_large_star(edges), "large")), "small")
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(edges.select("v", "v")).distinct()
