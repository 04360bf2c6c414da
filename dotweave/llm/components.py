"""Connected components of an edge table, by alternating large-star and small-star rounds.

Edges are rows (u, v) of longs; no edge and no component is collected. A node's
minimum meets its edges by an equi-join on the node. Hubs are apart: nodes of more
than ``HUB`` edges and of more than a ten-thousandth of all, of which there are at
most 20,000, get their minimum by a broadcast, so their edges are not shuffled to
one task. Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

HUB = 2_000


def _large(edges: DataFrame, count: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree"))
    hub = F.col("degree") > max(HUB, count // 10_000)
    hubs = F.broadcast(least.filter(hub).drop("degree"))
    up = both.filter("v > u")
    few = up.join(hubs.drop("m"), "u", "left_anti").join(least.filter(~hub).drop("degree"), "u")
    return few.unionByName(up.join(hubs, "u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges`` (u, v): the component is its smallest node."""
    mark = lambda e: e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    now = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = mark(now)
    while before["n"]:
        now = cut(_small(_large(now, before["n"])))
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
