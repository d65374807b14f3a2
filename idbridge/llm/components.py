"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (a plain aggregate, summed up on the map side
first) that all of the node's rows then meet. The rows of hubs, the nodes that hold more
than a ``HUBS``-th of all rows, meet it where they are: there are at most
``HUBS`` such nodes, whatever the graph, and their minima are broadcast. Other
rows are joined on the node. The work is done when the edges are stars around
their least nodes; nothing is collected but the number of nodes that deny it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store


HUBS = 1000  # at most so many nodes are broadcast


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def _met(rows: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``rows`` (u, v) with their node's m. ``total``: rows that ``least`` was made from, or more."""
    hubs = least.where(F.col("n") * HUBS > total).select("u", F.col("m").alias("hub"))
    told = rows.join(F.broadcast(hubs), "u", "left")
    others = told.where("hub is null").select("u", "v").join(least.select("u", "m"), "u")
    return others.unionAll(told.where("hub is not null").select("u", "v", F.col("hub").alias("m")))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of u is tied to u's smallest neighbour (or u)."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both).select("u", F.least("u", "m").alias("m"), "n")
    return (_met(both.where("v > u"), least, 2 * total)
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """u and every smaller neighbour of u are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minima(down)
    return (_met(down, least, total).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u > v, distinct) has one smaller neighbour, its
    component's least node, or is such a node itself."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionAll(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or up = 1 and down = 1").count() == 0


def components(edges: DataFrame, store: Store) -> DataFrame:
    """``edges`` (u, v: long) -> (node, root): root is the smallest node of
    the component. Nodes without an edge to another node do not appear."""
    edges = store.put(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u != v").distinct(), "edges")
    while not _are_stars(edges):
        total = edges.count()
        large = store.put(_large_star(edges, total), "star")  # as many rows as edges, or fewer
        step = store.put(_small_star(large, total), "star")
        store.drop(large, edges)
        edges = step
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
