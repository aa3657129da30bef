"""Connected components of links by alternating star contractions, all in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.least(F.col("node"), F.min("low")).alias("least"))
    above = both.filter("low > node").join(least, "node")
    return above.select(F.col("low").alias("node"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the least of them."""
    least = edges.groupBy("node").agg(F.min("low").alias("least"))
    moved = edges.join(least, "node").filter("low != least").select(F.col("low").alias("node"), F.col("least").alias("low"))
    return moved.unionByName(least.withColumnRenamed("least", "low")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Stars only: one parent for each node, and no parent below another."""
    parents = edges.select(F.col("low").alias("node")).distinct().withColumn("parent", F.lit(1))
    counts = edges.groupBy("node").agg(F.count("*").alias("n")).join(parents, "node", "left")
    return counts.filter("n > 1 or parent is not null").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is its least node.

    Loops, repeated and reversed links are allowed; links with a null end are ignored. Each round is
    written to the shared folder, and only its end test reaches the driver.
    """
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("low"))
    edges = written(edges.filter(f"{a} is not null and {b} is not null and node != low").distinct(), "links")
    while not _settled(edges):
        edges = written(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select("node", F.col("low").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
