"""Points in labelled regions, count matrices and their summaries, regions as pixel sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def assign(points: DataFrame, mask: DataFrame, rc: tuple[str, str], key: str = "dot_id") -> DataFrame:
    """``points`` with ``cell_id``, -1 outside: the label within half a pixel of a point, edges included.

    A point on a pixel's edge touches two pixels (four at a corner); the smallest label of them wins.
    """
    r, c = rc
    both = lambda x: F.array_distinct(F.array(F.floor(F.col(x) + 0.5), F.ceil(F.col(x) - 0.5)))
    near = points.filter(F.col(r).isNotNull() & F.col(c).isNotNull()).select(key, F.explode(both(r)).alias("_r"), both(c).alias("_cs")).withColumn("_c", F.explode("_cs"))
    hit = near.join(mask.select(F.col("r").cast("bigint").alias("_r"), F.col("c").cast("bigint").alias("_c"), "cell_id"), ["_r", "_c"])
    found = hit.groupBy(key).agg(F.min("cell_id").alias("cell_id"))
    return points.join(found, key, "left").withColumn("cell_id", F.coalesce("cell_id", F.lit(-1).cast("bigint")))


def gene_counts(assigned: DataFrame, gene: str, cell: str = "cell_id") -> DataFrame:
    """cell_id, gene, n of the points inside cells; partial counts combine before the shuffle."""
    return assigned.filter(F.col(cell) >= 0).groupBy(cell, gene).agg(F.count("*").alias("n"))


def matrix(counts: DataFrame, cells: list, gene: str, cell: str = "cell_id") -> DataFrame:
    """Genes by cells, absent pairs 0; the cells are named, so no pass over the data looks for them."""
    return counts.groupBy(gene).pivot(cell, cells).agg(F.sum("n")).na.fill(0)


def molecules(counts: DataFrame, cell: str = "cell_id", gene: str = "gene") -> DataFrame:
    return counts.groupBy(cell).agg(F.sum("n").alias("molecules"), F.countDistinct(gene).alias("genes"))


def medians(counts: DataFrame, cell: str = "cell_id", gene: str = "gene") -> DataFrame:
    return molecules(counts, cell, gene).agg(F.percentile("molecules", F.lit(0.5)).alias("median_molecules"), F.percentile("genes", F.lit(0.5)).alias("median_genes"))


def top_genes(counts: DataFrame, k: int, gene: str = "gene", most: bool = True) -> DataFrame:
    totals = counts.groupBy(gene).agg(F.sum("n").alias("total"))
    return totals.orderBy(F.desc("total") if most else F.asc("total"), gene).limit(k)


def distance_histogram(decoded: DataFrame, distance: str = "hamming_distance") -> DataFrame:
    return decoded.groupBy(distance).agg(F.count("*").alias("n"))


def regions(pixels: DataFrame, label: str = "obj_id") -> DataFrame:
    """Area and centroid of each label."""
    return pixels.groupBy(label).agg(F.count("*").alias("area"), F.avg("r").alias("centroid_r"), F.avg("c").alias("centroid_c"))


def shared_pixels(pixels: DataFrame, pairs: DataFrame, least: int, label: str = "obj_id", fov: str = "fov_num") -> DataFrame:
    """obj_a, obj_b of neighbouring tiles (pairs a, b) that share at least ``least`` pixels, and how many."""
    side = lambda s: pixels.select(F.col(fov).alias(s), F.col(label).alias(f"obj_{s}"), "r", "c")
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), ["b", "r", "c"])
    return joined.groupBy("obj_a", "obj_b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= least)


def best_couples(shared: DataFrame) -> DataFrame:
    """For each first object the second that it shares most with; ties to the smaller name."""
    best = Window.partitionBy("obj_a").orderBy(F.desc("shared"), "obj_b")
    return shared.withColumn("_k", F.row_number().over(best)).filter("_k = 1").drop("_k")


def merged_regions(pixels: DataFrame, couples: DataFrame, label: str = "obj_id") -> DataFrame:
    """Pixels where each second object of a couple has become part of its first; shared pixels once."""
    names = couples.groupBy(F.col("obj_b").alias(label)).agg(F.min("obj_a").alias("_into"))
    return pixels.join(names, label, "left").select(F.coalesce("_into", label).alias(label), "r", "c").distinct()


def label_canvas(pixels: DataFrame, label: str = "obj_id") -> DataFrame:
    """r, c, cell_id with cells numbered from 1 in the order of their names; a pixel of several goes to the last."""
    # one row per object: objects are some thousandths of the pixels
    names = pixels.select(label).distinct()
    numbered = names.withColumn("cell_id", F.row_number().over(Window.orderBy(label)).cast("bigint"))
    return pixels.join(numbered, label).groupBy("r", "c").agg(F.max("cell_id").alias("cell_id"))


def extent(points: DataFrame, r: str = "r", c: str = "c") -> DataFrame:
    return points.agg(F.min(r).alias("r_min"), F.max(r).alias("r_max"), F.min(c).alias("c_min"), F.max(c).alias("c_max"))


#: Side of a block of pixels, in pixels.
BLOCK = 256
_FAR = np.iinfo(np.int64).max // 4


def nearest_labels(labels: np.ndarray, distance: int) -> np.ndarray:
    """Of each pixel the nearest non-negative label within ``distance``, -1 if none; ties go to the smallest label.

    Two passes. Along the rows each pixel gets its nearest label, left or right, from running maxima. Down the columns
    the best of all rows within the distance wins: a pixel of row distance x in row dy away is x^2 + dy^2 away.
    """
    h, w = labels.shape
    column, some = np.arange(w), labels >= 0
    left = np.maximum.accumulate(np.where(some, column, -1), axis=1)
    right = (w - 1 - np.maximum.accumulate(np.where(some[:, ::-1], column, -1), axis=1))[:, ::-1]
    at = np.arange(h)[:, None]
    dl, dr = np.where(left >= 0, column - left, _FAR >> 40), np.where(right < w, right - column, _FAR >> 40)
    from_left, from_right = labels[at, left], labels[at, np.minimum(right, w - 1)]
    pick = (dr < dl) | ((dr == dl) & (from_right < from_left))
    along, label = np.minimum(dl, dr).astype(np.int64) ** 2, np.where(pick, from_right, from_left)
    best, winner = np.full(labels.shape, _FAR), np.full(labels.shape, -1, np.int64)
    for dy in range(-distance, distance + 1):
        to, by = slice(max(0, -dy), min(h, h - dy)), slice(max(0, dy), min(h, h + dy))
        far, name = along[by] + dy * dy, label[by]
        better = (far < best[to]) | ((far == best[to]) & (name < winner[to]))
        best[to] = np.where(better, far, best[to])
        winner[to] = np.where(better, name, winner[to])
    return np.where(best <= distance * distance, winner, -1)


def expand_labels(mask: DataFrame, distance: int, rows: int, cols: int) -> DataFrame:
    """``mask`` (r, c, cell_id) grown by ``distance`` pixels: a background pixel takes the nearest label, ties the smallest.

    The canvas is cut into blocks of pixels with a halo of the distance, and each block is an exact distance transform in
    two passes (:func:`nearest_labels`): work a pixel grows with the distance, not with its square, and what is shuffled
    are the labelled pixels, those near a block's edge once more for each block they reach.
    """
    side = max(BLOCK, distance)
    span = lambda x: F.explode(F.sequence(F.floor((F.col(x) - distance) / side), F.floor((F.col(x) + distance) / side)))
    inside = mask.filter(F.col("cell_id").isNotNull() & F.col("r").between(-distance, rows - 1 + distance) & F.col("c").between(-distance, cols - 1 + distance))
    tiled = inside.select(F.col("r").cast("bigint").alias("r"), F.col("c").cast("bigint").alias("c"), F.col("cell_id").cast("bigint").alias("cell_id")).withColumn("_i", span("r")).withColumn("_j", span("c"))

    def run(group):
        r, c, label = (np.asarray(group.column(x)) for x in ("r", "c", "cell_id"))
        top, first = int(group.column("_i")[0].as_py()) * side, int(group.column("_j")[0].as_py()) * side
        # labels by rank, so that -1 can stand for none
        names, rank = np.unique(label, return_inverse=True)
        labels = np.full((side + 2 * distance, side + 2 * distance), len(names), np.int64)
        np.minimum.at(labels, (r - top + distance, c - first + distance), rank)
        grown = nearest_labels(np.where(labels < len(names), labels, -1), distance)[distance : distance + side, distance : distance + side]
        i, j = np.nonzero(grown >= 0)
        keep = (i + top >= 0) & (i + top < rows) & (j + first >= 0) & (j + first < cols)
        i, j = i[keep], j[keep]
        return pa.table({"r": i + top, "c": j + first, "cell_id": names[grown[i, j]]})

    return tiled.groupBy("_i", "_j").applyInArrow(run, "r bigint, c bigint, cell_id bigint")
