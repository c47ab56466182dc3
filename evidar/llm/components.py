"""Connected components of a graph whose edges are a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidar.llm.common import discard, written


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the least node that can be reached) for each node of edges(a, b). Each round is
    two aggregates and two joins over the edges and is written to the shared folder."""
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = written(both, "components")
    state = _state(stars)
    for _ in range(rounds):
        after = written(_small_star(_large_star(stars)), "components")
        discard(stars)
        stars = after
        state, before = _state(stars), state
        if state == before:
            # every edge now leads from a node to its root
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"no end after {rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its greater neighbours to the least of its neighbours and itself. edges: u > v."""
    around = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
    least = around.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
    greater = edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    return greater.join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node sends its lesser neighbours and itself to the least of them. edges: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
