"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import staged


def _least(edges: DataFrame) -> DataFrame:
    """``(u, m)``: the smallest neighbour of every node.

    Dealt out anew, so that it meets the edges by an exchange of its own: a join
    straight on the aggregate's partitioning could not split a hub's edges.
    """
    width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.groupBy("u").agg(F.min("v").alias("m")).repartition(width)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = _least(edges)
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has just one, which has none itself."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node with an edge; component is the smallest node.

    ``edges`` has two long columns.  Groups are never gathered: minima combine
    map-side and joins on a hub are split at run time.  Each step is written to
    the shared folder; the loop ends when all components are stars around their smallest node, which takes
    a logarithmic number of rounds.  Null ends and self loops are ignored.
    """
    a, b = edges.columns[:2]
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = staged(edges.filter("u <> v").distinct(), "components-edges")
    while not _are_stars(edges):
        edges = staged(_large_star(edges).distinct(), "components-large")
        edges = staged(_small_star(edges).distinct(), "components-small")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
