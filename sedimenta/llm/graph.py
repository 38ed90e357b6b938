"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import Store


def _stars(pairs: DataFrame) -> bool:
    """Whether every node has one neighbour below it, which has none itself."""
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
    ends = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return ends.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame, store: Store) -> DataFrame:
    """``(node, component)`` for every node of the pairs ``(a, b)``.

    The component is the smallest node that links lead to.  Alternates large
    star (neighbours above a node move to its smallest neighbour) and small
    star (those below it) until only stars are left; a hub is an aggregated minimum
    and a join, never a list.
    """
    pairs = store.keep(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(pairs):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        pairs = store.keep(small.filter("x.v <> x.m").select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).distinct())
    return (pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def extended(known: DataFrame, edges: DataFrame, store: Store) -> DataFrame:
    """``known``, a kept result of ``components``, after more ``edges``, kept.

    Nodes stand for their components, so only links between different ones are
    followed; without any, ``known`` itself is the result.
    """
    for end in ("a", "b"):
        at = known.select(F.col("node").alias(end), F.col("component").alias("c"))
        edges = edges.join(at, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    across = store.keep(edges.filter("a <> b").distinct())
    if across.isEmpty():
        return known
    joined = store.keep(components(across, store))
    moved = known.join(joined.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    return store.keep(moved.select("node", F.coalesce("top", "component").alias("component")).union(joined).distinct())
