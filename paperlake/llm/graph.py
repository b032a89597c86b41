"""Connected components over links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return (both.filter("v > u").join(low, "u").filter("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours are linked to the smallest of them (``u > v`` holds in ``edges``)."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    rest = edges.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return rest.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of each component, for the nodes that have links.

    Alternates large-star and small-star until every component is a star.
    Each step is a grouping by a minimum and joins; no component is gathered.
    Links with a null end or to the node itself count for nothing.
    """
    now = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
           .filter("_a is not null and _b is not null and u <> v").select("u", "v").distinct())
    now = cut_lineage(now, "links")
    seen = None
    while True:
        # a star forest has one parent per node, and no parent is a child
        shape = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if shape[0] == 0 or tuple(shape) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = tuple(shape)
        now = cut_lineage(_small_star(_large_star(now)), "links")
