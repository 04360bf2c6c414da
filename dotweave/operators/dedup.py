"""Duplicates of neighbouring tiles: removal by identity and distance, and clipping of overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geometry import in_overlaps
from .spatial import radius_join


def duplicated(points: DataFrame, rects: DataFrame, radius: float, rc: tuple[str, str], gene: str, key: str = "dot_id", fov: str = "fov_num", strict: bool = False) -> DataFrame:
    """Keys of the points of an overlap's second tile near a point of its first tile with the same gene.

    All pairs of tiles are decided on the points as they are, so their order does not matter.
    """
    inside = in_overlaps(points.filter(F.col(gene).isNotNull()).select(key, fov, gene, *rc), rects, rc, fov)
    first = inside.filter("side = 'a'").select("a", "b", gene, *rc)
    second = inside.filter("side = 'b'").select("a", "b", gene, key, *rc)
    return radius_join(second, first, radius, rc, rc, ["a", "b", gene], strict).select(key).distinct()


def split_by(points: DataFrame, ids: DataFrame, key: str = "dot_id") -> tuple[DataFrame, DataFrame]:
    """(cleaned, removed)"""
    return points.join(ids, key, "left_anti"), points.join(ids, key, "left_semi")


def clip_cuts(rects: DataFrame, clip_r: float, clip_c: float) -> DataFrame:
    """Where each overlap is cut: across its rows if it is wider than tall, else across its columns."""
    tall, wide = F.col("r_br") - F.col("r_tl"), F.col("c_br") - F.col("c_tl")
    rows = wide > tall
    return rects.withColumns({"by_rows": rows, "cut": F.when(rows, F.col("r_tl") + tall * clip_r).otherwise(F.col("c_tl") + wide * clip_c)})


def clip(points: DataFrame, rects: DataFrame, rc: tuple[str, str], clip_r: float = 0.5, clip_c: float = 0.5, key: str = "dot_id", fov: str = "fov_num") -> DataFrame:
    """Points strictly on their own side of every cut of their tile's overlaps.

    A tile keeps what violates none of its cuts, so this is one anti-join and its order does not matter.
    """
    cuts = clip_cuts(rects, clip_r, clip_c)
    first = F.when(F.col("by_rows"), F.col("a_row") == "top").otherwise(F.col("a_column") == "left")
    ends = [cuts.select(F.col(s).alias(fov), "by_rows", "cut", (first if s == "a" else ~first).alias("below")) for s in ("a", "b")]
    joined = points.select(key, fov, *rc).join(ends[0].union(ends[1]), fov)
    at = F.when(F.col("by_rows"), F.col(rc[0])).otherwise(F.col(rc[1]))
    bad = joined.filter(F.when(F.col("below"), at >= F.col("cut")).otherwise(at <= F.col("cut")))
    return points.join(bad.select(key).distinct(), key, "left_anti")
