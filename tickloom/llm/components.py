"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans.scratch import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w")).select(
        F.col("m").alias("a"), F.col("v").alias("b")).where(F.col("a") != F.col("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, are linked to the smallest of them."""
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = ordered.groupBy("u").agg(F.min("v").alias("m"))
    others = ordered.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(
        F.col("m").alias("a"), F.col("v").alias("b"))
    return others.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).where(F.col("a") != F.col("b"))


def components(edges: DataFrame) -> DataFrame:
    """node, component of every node of ``edges`` (a, b): the smallest node it can reach.

    Edges may be repeated, point either way or join a node to itself; those with a null end are left out.
    The stars repeat until the edge table no longer changes; each round is a written table, so no plan grows and
    no round is repeated when an executor is lost. A node's neighbours are never gathered: both steps
    are a minimum and an equality join, which Spark pre-aggregates and may split.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(
        F.col("a") < F.col("b")).distinct())
    last = None
    while True:
        edges = stored(small_star(stored(large_star(edges).distinct())).distinct())
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == last or mark["n"] == 0:
            break
        last = mark
    stars = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return stars.union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
