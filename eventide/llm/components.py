"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.llm.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: (u, v) long.  Returns (node, component): the smallest node
    that each node with an edge reaches.

    Large star: every node hands its larger neighbours the smallest node it
    knows; small star: its smaller ones and itself.  Depth halves each time.
    Each step is a partial-aggregated minimum per node and a join of edges with
    the written minima, so that AQE can split a node with very many edges.
    Nothing but two numbers per step reaches the driver.
    """
    edges = materialize(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-low")
        large = materialize(both.join(low, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        edges = materialize(
            large.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
