"""Connected components of a link table, by contraction; nothing of the graph leaves the executors.

Every node points to its smallest neighbour or itself, pointers are followed to
their ends, and links between the ends make the next, smaller graph.  A node with
many links is met by minima with a map-side combine and by joins that adaptive
execution splits, never by a list of its links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b), both long."""
    edges = stage(_ordered(links))
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        points = both.groupBy("node").agg(F.min("other").alias("other"))
        points = stage(points.select("node", F.least("node", "other").alias("up")))
        while True:
            ends = points.select(F.col("node").alias("up"), F.col("up").alias("end"))
            moved = stage(points.join(ends, "up").select("node", F.col("end").alias("up"), (F.col("end") != F.col("up")).alias("moved")))
            points = moved.select("node", "up")
            if moved.where("moved").isEmpty():
                break
        levels.append(points)
        first = points.select(F.col("node").alias("a"), F.col("up").alias("a_end"))
        second = points.select(F.col("node").alias("b"), F.col("up").alias("b_end"))
        joined = edges.join(first, "a").join(second, "b").select(F.col("a_end").alias("a"), F.col("b_end").alias("b"))
        edges = stage(_ordered(joined))
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = levels[0]
    for above in levels[1:]:
        ends = above.select(F.col("node").alias("up"), F.col("up").alias("end"))
        found = found.join(ends, "up", "left").select("node", F.coalesce("end", "up").alias("up"))
    return found.withColumnRenamed("up", "component")


def _ordered(links: DataFrame) -> DataFrame:
    pairs = links.where(F.col("a") != F.col("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
