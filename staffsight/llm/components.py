"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, save


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _attach(pairs: DataFrame, include_self: bool) -> DataFrame:
    """For rows (n, w), w a neighbour of n: each w with the smallest of n's neighbours (and n)."""
    least = F.least(F.min("w"), F.col("n")) if include_self else F.min("w")
    lowest = pairs.groupBy("n").agg(least.alias("m")).withColumnRenamed("n", "of")
    return pairs.join(lowest, F.col("n") == F.col("of")).select("n", "w", "m")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Nothing but edge counts and checksums reaches the driver. A node's smallest neighbour is
    found by a partial aggregate, so a node with very many links costs no single task more.
    """
    edges = save(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("w")).unionAll(
            edges.select(F.col("v").alias("n"), F.col("u").alias("w")))
        large = _attach(both, True).where("w > n").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _attach(large.select(F.col("u").alias("n"), F.col("v").alias("w")), False)
        step = small.select(F.col("w").alias("u"), F.col("m").alias("v")).unionAll(
            small.select(F.col("n").alias("u"), F.col("m").alias("v")))
        done, edges = edges, save(step.where("u <> v").distinct(), "cc")
        forget(done)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
