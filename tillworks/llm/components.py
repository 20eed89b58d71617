"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.session import in_few_files, stored


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of its neighbours; summed up before the shuffle, so a hub is no hot key."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node among it and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u").where(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges`` (``u``, ``v``).

    Edges are undirected, may repeat and may be loops; rows with a NULL are ignored, and nodes without
    an edge to another node do not come back. Rounds go on until one changes nothing; each is written
    to the shared work folder, so a lost executor costs one round at most.
    """
    now = stored(edges.select("u", "v").where("u <> v").distinct(), "star")
    mark = _mark(now)
    while mark[0]:
        # A round leaves no more edges than it was given and a row per node: few small files.
        now = stored(in_few_files(small_star(large_star(now)), 2 * mark[0]), "star")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
