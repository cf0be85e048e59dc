"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sources.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _downwards(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the pairs (u, v); the component is its smallest node.

    Each step is two joins and an aggregate over the edges; a node's neighbours are
    never gathered in one row, so a node with very many edges is only a skewed join
    key. The number of steps grows with the logarithm of the longest chain. Every
    step's edges are written to the shared folder, so a lost executor costs one step.
    """
    edges = materialize(_downwards(edges), "edges")
    before = None
    while before != (now := _state(edges)):
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least")  # so that the join can split a node of very many edges
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(
            _downwards(small.unionByName(least.select("u", F.col("m").alias("v")))), "edges"
        )
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)
