"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u long, v long).

    ``component`` is the smallest node reachable. Every round replaces each
    node's edges by edges to its smallest neighbour: large-star moves the
    larger neighbours there, small-star the smaller ones, until the edges are
    stars around the smallest nodes and stay the same. Self loops and
    repeated edges are harmless; no edges give no rows. Each step's minima
    are stored before they are joined back, so a hub is a splittable join
    side rather than one task's group.
    """
    edges = stage(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    seen = _state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "large-star")
        larger = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(larger.distinct(), "edges")
        lowest = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        smaller = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(smaller.unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "edges")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())
