"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps: each turns the edges of a node towards
its smallest neighbour until every component is a star around its smallest node,
after a logarithmic number of rounds. A node's smallest neighbour is aggregated in
the tasks that hold its edges and written down before it is joined back, so the
edges of a hot node can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import staged


def _towards_least(edges: DataFrame, name: str) -> DataFrame:
    """``edges`` (u, v) with ``least``, the smallest of u and all its v."""
    least = staged(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least")), name)
    return edges.join(least, "u")


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("decimal(38,0)"))
                     ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of the edges (``u``, ``v``); the component is
    its smallest node. Loops and repeated edges may occur."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                              F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_towards_least(both, "least").where("v > u")
                       .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "large")
        small = _towards_least(large, "least")
        now = staged(small.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
                     .unionByName(small.select("u", F.col("least").alias("v")))
                     .where("u <> v").distinct(), "small")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
