"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least node of its surroundings."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v: longs) to (node, label): the least node of its component.

    Nodes without a link to another node do not appear.  Each round is written
    to the shared folder, so a round is never repeated; per node only a minimum
    is kept, so a node with very many links is no single task's work (the joins
    back to the links are ones that Spark splits).
    """
    edges = written(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        large = written(_large_star(edges), "large-star")
        small = written(_small_star(large), "small-star")
        drop_written(edges, large)
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
