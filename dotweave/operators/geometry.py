"""Tile geometry: axis conventions, corners, adjacency, overlaps, and points in overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selection import first_of, in_box
from .spatial import nearest_k_within

#: The anchor corner of the tiles of each machine, and the axes that its stage inverts.
CORNERS = {"ROBOFISH1": "top-left", "ROBOFISH2": "top-right", "ROBOFISH3": "bottom-left"}
INVERTED = {"ROBOFISH1": "", "ROBOFISH2": "x", "ROBOFISH3": "xy"}


def stage_coordinates(images: DataFrame, round_num: int) -> DataFrame:
    """fov_num, x, y of each tile in a round, in the order of tiles."""
    rows = images.filter(F.col("round_num") == round_num).select("fov_num", F.col("fov_acquisition_coords_x").alias("x"), F.col("fov_acquisition_coords_y").alias("y"))
    return first_of(rows, ["fov_num"], ["x", "y"])


def tile_corners(coords: DataFrame, machine: str, pixel_microns: float) -> DataFrame:
    """fov_num, r, c in pixels: axes inverted as the stage needs, moved to zero, y to rows and x to columns."""
    if machine not in CORNERS:
        raise ValueError(f"no tile corner is defined for machine {machine!r}")
    flip = INVERTED[machine]
    turned = coords.select("fov_num", (F.col("x") * (-1 if "x" in flip else 1)).alias("x"), (F.col("y") * (-1 if "y" in flip else 1)).alias("y"))
    low = turned.agg(F.min("x").alias("x0"), F.min("y").alias("y0"))  # one row
    moved = turned.crossJoin(F.broadcast(low))
    return moved.select("fov_num", ((F.col("y") - F.col("y0")) / pixel_microns).alias("r"), ((F.col("x") - F.col("x0")) / pixel_microns).alias("c"))


def tile_corners_mirrored(coords: DataFrame, pixel_microns: float) -> DataFrame:
    """The older convention: both axes measured down from their maximum."""
    high = coords.agg(F.max("x").alias("x1"), F.max("y").alias("y1"))
    return coords.crossJoin(F.broadcast(high)).select("fov_num", ((F.col("y1") - F.col("y")) / pixel_microns).alias("r"), ((F.col("x1") - F.col("x")) / pixel_microns).alias("c"))


def stitched(r: Column, c: Column, tile_r: Column, tile_c: Column, corner: str, width: float, height: float) -> tuple[Column, Column]:
    """Position of a dot (r, c) of a tile on the stitched canvas, by the tile's anchor corner."""
    rows = {"top-left": tile_r + r, "top-right": tile_r + r, "bottom-left": tile_r + (height - r), "bottom-right": tile_r + (height - r), "mirrored": tile_r - r}
    cols = {"top-left": tile_c + c, "bottom-left": tile_c + c, "top-right": tile_c - (width - c), "bottom-right": tile_c - (width - c), "mirrored": tile_c - c}
    if corner not in rows:
        raise ValueError(f"unknown corner {corner!r}")
    return rows[corner], cols[corner]


def stitch(df: DataFrame, tiles: DataFrame, corner: str, width: float, height: float, rc: tuple[str, str] = ("r_px_registered", "c_px_registered"), tag: str = "microscope_stitched") -> DataFrame:
    """Adds r_px_<tag>, c_px_<tag>; ``tiles``: fov_num, r, c."""
    joined = df.join(tiles.select("fov_num", F.col("r").alias("_tr"), F.col("c").alias("_tc")), "fov_num", "left")
    row, col = stitched(F.col(rc[0]), F.col(rc[1]), F.col("_tr"), F.col("_tc"), corner, width, height)
    return joined.withColumns({f"r_px_{tag}": row, f"c_px_{tag}": col}).drop("_tr", "_tc")


def stitch_objects(pixels: DataFrame, tiles: DataFrame, corner: str, width: float, height: float, obj: str = "obj_id", tag: str = "stitched") -> tuple[DataFrame, DataFrame]:
    """Segmented objects on the canvas: their pixels, and a row an object with its centroid and number of pixels, each with r_px_<tag>, c_px_<tag>.

    ``pixels``: fov_num, ``obj``, r, c. Objects of tiles without a place have null positions.
    """
    centroids = pixels.groupBy("fov_num", obj).agg(F.avg("r").alias("r"), F.avg("c").alias("c"), F.count("*").alias("n"))
    return tuple(stitch(x, tiles, corner, width, height, ("r", "c"), tag) for x in (pixels, centroids))


def adjacent(tiles: DataFrame, image_size: float, key: str = "fov_num") -> DataFrame:
    """Pairs a, b of neighbouring tiles, each once.

    b is one of a's four nearest tiles and nearer than ``image_size``. Where both name each other the smaller
    number comes first, where only one does, that one.
    """
    near = nearest_k_within(tiles, 4, image_size, ("r", "c"), key).select("a", "b")
    back = near.select(F.col("b").alias("a"), F.col("a").alias("b"))
    again = near.join(back, ["a", "b"], "left_semi").filter(F.col("a") > F.col("b"))
    return near.join(again, ["a", "b"], "left_anti")


def overlaps(tiles: DataFrame, pairs: DataFrame, corner: str, width: float, height: float, key: str = "fov_num") -> DataFrame:
    """The rectangle that two tiles share, and which of them is above and left."""
    side = lambda name: tiles.select(F.col(key).alias(name), F.col("r").alias(f"{name}r"), F.col("c").alias(f"{name}c"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def span(one: Column, two: Column, size: float, far: bool) -> tuple[Column, Column]:
        back = float(size) if far else 0.0
        return F.greatest(one, two) - back, F.least(one, two) + size - back

    r0, r1 = span(F.col("ar"), F.col("br"), height, corner.startswith("bottom"))
    c0, c1 = span(F.col("ac"), F.col("bc"), width, corner.endswith("right"))
    return both.select(
        "a", "b", r0.alias("r_tl"), r1.alias("r_br"), c0.alias("c_tl"), c1.alias("c_br"),
        F.when(F.col("ar") > F.col("br"), "bottom").otherwise("top").alias("a_row"), F.when(F.col("ac") > F.col("bc"), "right").otherwise("left").alias("a_column"),
    )


def in_overlaps(points: DataFrame, rects: DataFrame, rc: tuple[str, str], fov: str = "fov_num", strict: bool = True) -> DataFrame:
    """Points inside an overlap of their own tile, once for each: with a, b and ``side`` ('a' or 'b').

    An equi-join on the tile, so the box is only tested against the tile's own overlaps.
    """
    box = ["r_tl", "r_br", "c_tl", "c_br"]
    ends = [rects.select(F.col(s).alias(fov), "a", "b", *box, F.lit(s).alias("side")) for s in ("a", "b")]
    joined = points.join(ends[0].union(ends[1]), fov)
    return joined.filter(in_box(F.col(rc[0]), F.col(rc[1]), tuple(map(F.col, box)), strict)).drop(*box)


def chunks(rows: int, cols: int, size: int, spark) -> DataFrame:
    """Regions r0, r1, c0, c1 of a canvas: floor(n / size) chunks an axis, the last one with the remainder."""
    axis = lambda n, a, b: (
        spark.range(max(n // size, 1)).select((F.col("id") * size).alias(a), F.when(F.col("id") == max(n // size, 1) - 1, F.lit(n)).otherwise((F.col("id") + 1) * size).cast("long").alias(b))
    )
    return axis(rows, "r0", "r1").crossJoin(axis(cols, "c0", "c1"))


def count_in_chunks(points: DataFrame, size: int, rc: tuple[str, str] = ("r", "c")) -> DataFrame:
    """r0, r1, c0, c1 and ``n``, the points in it, of each chunk of the points' canvas that has any; chunks as of :func:`chunks`."""
    r, c = rc
    canvas = points.agg((F.floor(F.max(r)) + 1).alias("_h"), (F.floor(F.max(c)) + 1).alias("_w"))  # one row

    def axis(x: str, n: str) -> tuple[Column, Column]:
        parts = F.greatest(F.floor(F.col(n) / size), F.lit(1))
        at = F.least(F.floor(F.col(x) / size), parts - 1)
        return at * size, F.when(at == parts - 1, F.col(n)).otherwise((at + 1) * size)

    (r0, r1), (c0, c1) = axis(r, "_h"), axis(c, "_w")
    placed = points.crossJoin(F.broadcast(canvas)).select(r0.alias("r0"), r1.alias("r1"), c0.alias("c0"), c1.alias("c1"))
    return placed.groupBy("r0", "r1", "c0", "c1").agg(F.count("*").alias("n"))
