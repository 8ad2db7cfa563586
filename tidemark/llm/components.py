"""Connected components of an edge table, in rounds of joins and aggregates on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node's neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge runs from a node of no other edge to a centre that is the larger end of none."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("larger"), F.lit(0).alias("smaller")).union(edges.select("b", F.lit(0), F.lit(1)))
    each = ends.groupBy("id").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return not each.where("larger + smaller > 1").agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """`id` and `component` (the smallest id reachable) of every id that has an edge.

    `edges` has two long columns, `a` and `b`; order, repeats and loops do not matter, nulls are no
    ends. Two star contractions alternate until all edges are stars, which they would leave as they are: each is written once, so that its plan
    stays small; their rows never exceed the edges, and a node with very many edges is spread over the join's
    partitions by adaptive execution. No part of the graph is gathered in one place.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        if _are_stars(edges):
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", F.col("b")).distinct())
        edges = settle(_small_star(settle(_large_star(edges))))
    raise RuntimeError("components did not settle")
