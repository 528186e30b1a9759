"""Connected components by alternating large-star and small-star, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genomill.llm.common import cut, discard


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u > v). Large: every larger neighbour of u is linked to u's smallest; small: the smaller ones are."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")) if large else both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node is either a centre or hangs on one centre only: then no step changes anything."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches. Nodes without edges are not listed.

    Nulls and self-loops link nothing; repeated edges count once. Every round is written to the shared folder, and the
    loop ends when all edges are stars around smallest nodes, after about the logarithm of the number of nodes rounds.
    """
    current = cut(edges.where(f"{src} IS NOT NULL AND {dst} IS NOT NULL AND {src} <> {dst}").select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).distinct())
    while not _settled(current):
        after = cut(_stars(_stars(current, large=True), large=False))
        discard(current)
        current = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
