"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``links``: the smallest node that it
    reaches. Links are undirected; loops and repeats are allowed.

    Each round links all larger neighbours of a node to its smallest one and
    then all smaller ones, which halves the height of the trees; a few rounds
    serve any length of chain. Every round is checkpointed.
    """
    edges = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        if after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty():
            break
        edges = after
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"))
