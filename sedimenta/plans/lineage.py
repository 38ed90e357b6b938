"""Lineage edges: neighbours, impact, staleness.

An edge frame has ``source_table, target_table`` and, where used,
``target_type, created_at``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.scale import durable, hot_keys, salted_join

MAX_DEPTH = 10


def recent_edges(edges: DataFrame, pattern: str, n: int) -> DataFrame:
    """The newest ``n`` edges into tables whose name fits."""
    return (
        edges.filter(F.col("target_table").like(pattern))
        .orderBy(F.desc("created_at"), "source_table", "target_table")
        .limit(n)
    )


def neighbours(edges: DataFrame) -> DataFrame:
    """Number of direct sources and targets of every table."""
    ends = edges.select(
        F.explode(F.array(
            F.struct(F.col("target_table").alias("table_name"), F.lit(1).alias("up"), F.lit(0).alias("down")),
            F.struct(F.col("source_table").alias("table_name"), F.lit(0).alias("up"), F.lit(1).alias("down")),
        )).alias("e")
    ).select("e.*")
    return ends.groupBy("table_name").agg(
        F.sum("up").alias("upstream_count"), F.sum("down").alias("downstream_count")
    )


def impact(edges: DataFrame, start: str, depth: int = MAX_DEPTH) -> DataFrame:
    """Tables reached from ``start`` per level with the number of paths.

    One join per level.  Paths that meet in a table are added up before the
    next level, so a level is never larger than the number of tables.  Each
    level is written out: the plan stays short and a lost executor repeats
    one level at most.
    """
    links = durable(
        edges.groupBy("source_table", "target_table").agg(F.count(F.lit(1)).alias("_links")), "links"
    )
    hot = hot_keys(links, ["source_table"])
    levels = []
    front = None
    for level in range(1, depth + 1):
        if front is None:
            step = links.filter(F.col("source_table") == start).withColumn("_paths", F.col("_links"))
        else:
            known = front.select(F.col("table_name").alias("source_table"), F.col("impact_count"))
            step = salted_join(links, known, ["source_table"], "inner", hot).withColumn(
                "_paths", F.col("_links") * F.col("impact_count")
            )
        front = durable(
            step.groupBy(F.col("target_table").alias("table_name")).agg(F.sum("_paths").alias("impact_count")),
            f"level-{level}",
        )
        if front.isEmpty():
            break
        levels.append(front.select("table_name", F.lit(level).alias("level"), "impact_count"))
    if not levels:
        return front.select("table_name", F.lit(0).alias("level"), "impact_count")
    return reduce(DataFrame.union, levels)


def diagnosis(tables: DataFrame, edges: DataFrame, known: Column) -> DataFrame:
    """State of the lineage per table: unregistered, none, or normal.

    ``known`` says for a row of ``tables`` whether the table is registered.
    """
    last = edges.groupBy(F.col("target_table").alias("table_name")).agg(F.max("created_at").alias("last_update"))
    state = (
        F.when(~known, "Table not registered")
        .when(F.col("last_update").isNull(), "No lineage information found")
        .otherwise("Lineage tracking appears normal")
    )
    return tables.join(last, "table_name", "left").withColumn("diagnosis", state)
