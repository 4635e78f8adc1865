"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round: each node's neighbours are linked to the least of them and it
    itself.  A large star moves the neighbours above the node, a small star those
    below it and the node."""
    near = _both_ways(edges) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # The minima are stored, so that both sides of the join are exchanged for it and a
    # node with very many neighbours can be split.
    least = stored(near.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")
    linked = near.join(least, "u")
    if large:
        linked = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    linked = linked.where(F.col("u") != F.col("v"))
    return linked if large else linked.distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge up to a centre that has none itself."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return (ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that has an edge, but the least of each component, with that
    least node.  Large and small stars alternate until each component is a star (edges
    always point to the smaller node, so its centre is the least); each round's edges are
    stored in the shared folder."""
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where(F.col("u") != F.col("v")).distinct(), "edges")
    while not _are_stars(edges):
        edges = stored(_star(_star(edges, True), False), "edges")
    return edges
