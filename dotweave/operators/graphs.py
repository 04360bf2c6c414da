"""Graphs as tables of edges: connected components and edge colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of ``edges`` (a, b): the root is the smallest node of the component.

    Large and small stars in turn: each node hands its larger neighbours, then its smaller ones and itself, to the smallest of them, until no
    edge changes. A round is a grouped minimum and a join; its edges are cut off in the shared folder.
    """
    now = cut(edges.select("a", "b").filter("a <> b").distinct())
    mark = None
    while True:
        around = _both_ways(now)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # in every edge the larger node comes first now
        down = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        now = cut(small)
        made = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if made == mark or not made["n"]:
            break
        mark = made
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def edge_colours(edges: DataFrame, order: Column | None = None) -> list[DataFrame]:
    """``edges`` (a, b, further columns) in classes, none with two edges at one node.

    Each round takes the edges that come first (by ``order`` if given, then by hash and name) of all at both of their nodes,
    which no other such edge touches. A grid of tiles takes some five rounds, whatever its size.
    """
    first_by = F.struct((F.lit(0) if order is None else order).alias("o"), F.xxhash64("a", "b").alias("h"), F.col("a").alias("a"), F.col("b").alias("b"))
    left, classes = cut(edges.withColumn("_h", first_by)), []
    while not left.isEmpty():
        ends = left.select(F.explode(F.array("a", "b")).alias("node"), "_h")
        first = ends.groupBy("node").agg(F.min("_h").alias("_h")).groupBy("_h").agg(F.count("*").alias("n")).filter("n = 2").select("_h")
        classes.append(cut(left.join(first, "_h", "left_semi")).drop("_h"))
        left = cut(left.join(first, "_h", "left_anti"))
    return classes
