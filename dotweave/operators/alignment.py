"""Aligning point clouds: the commonest offset of two sets, transforms, centres."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut

#: Points handled at once where each meets many others.
BLOCK = 4_096


def _density(points: np.ndarray, at: np.ndarray, bandwidth: float) -> np.ndarray:
    total = np.zeros(len(at))
    for i in range(0, len(points), BLOCK):
        d2 = ((at[:, None] - points[None, i : i + BLOCK]) ** 2).sum(axis=2)
        total += np.exp(-0.5 * d2 / bandwidth**2).sum(axis=1)
    return total


def near_offsets(a: np.ndarray, b: np.ndarray, radius: float) -> np.ndarray:
    """a - b of all pairs within ``radius``; points meet in cells of that side, BLOCK points of b at once."""
    cell, other = (np.floor(x / radius).astype(np.int64) for x in (a, b))
    low = np.minimum(cell.min(axis=0), other.min(axis=0)) - 1
    width = max(cell[:, 1].max(), other[:, 1].max()) - low[1] + 3
    number = lambda x: (x[:, 0] - low[0]) * width + x[:, 1] - low[1]
    order = np.argsort(number(cell), kind="stable")
    places, found = number(cell)[order], []
    for at in range(0, len(b), BLOCK):
        for i in (-1, 0, 1):
            # the three cells of a row of cells are neighbours in the order
            first = number(other[at : at + BLOCK] + (i, -1))
            start, end = np.searchsorted(places, first, "left"), np.searchsorted(places, first + 2, "right")
            n = end - start
            row = np.repeat(np.arange(len(n)), n)
            d = a[order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)]] - b[at + row]
            found.append(d[(d**2).sum(axis=1) <= radius * radius])
    return np.concatenate(found)


def density_mode(points: np.ndarray, radius: float, bandwidth: float = 5, step: float = 0.05, most: int = 500) -> np.ndarray:
    """The densest place of a cloud around zero: the best point of a coarse grid inside the circle, then uphill to the best of eight neighbours."""
    grid = np.arange(-radius, radius, radius / 5)
    cells = np.stack(np.meshgrid(grid, grid), axis=-1).reshape(-1, 2)
    cells = cells[(cells**2).sum(axis=1) < radius * radius]
    score = _density(points, cells, bandwidth)
    at, best = cells[score.argmax()], score.max()
    around = np.array([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]) * step
    for _ in range(most):
        score = _density(points, at + around, bandwidth)
        if score.max() <= best:
            break
        at, best = at + around[score.argmax()], score.max()
    return at


def offset_of(a: np.ndarray, b: np.ndarray, radius: float = 20, **how) -> np.ndarray | None:
    """What b must move by to lie on a, from the offsets of all pairs within ``radius``; none if there is no pair."""
    near = near_offsets(a, b, radius) if len(a) and len(b) else np.zeros((0, 2))
    return density_mode(near, radius, **how) if len(near) else None


def pair_offsets(points: DataFrame, rects: DataFrame, rc: tuple[str, str], radius: float = 20, least: int = 10, fov: str = "fov_num") -> DataFrame:
    """a, b, dr, dc, n_a, n_b of each overlap with more than ``least`` points on both sides. A group is one overlap's points."""
    from .geometry import in_overlaps

    inside = in_overlaps(points.select(fov, *rc), rects, rc, fov, strict=False).select("a", "b", "side", F.col(rc[0]).alias("r"), F.col(rc[1]).alias("c"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        one, two = (group[group["side"] == s][["r", "c"]].to_numpy(float) for s in ("a", "b"))
        at = offset_of(one, two, radius) if min(len(one), len(two)) > least else None
        dr, dc = (None, None) if at is None else at
        return pd.DataFrame([(*key, dr, dc, len(one), len(two))], columns=["a", "b", "dr", "dc", "n_a", "n_b"]).astype({"dr": "float64", "dc": "float64"})

    kind = rects.schema["a"].dataType.simpleString()
    return inside.groupBy("a", "b").applyInPandas(run, f"a {kind}, b {kind}, dr double, dc double, n_a long, n_b long")


def box_centre(df: DataFrame, r: str = "r", c: str = "c") -> DataFrame:
    return df.agg(((F.min(r) + F.max(r)) / 2).alias("r"), ((F.min(c) + F.max(c)) / 2).alias("c"))


def mean_centre(df: DataFrame, r: str = "r", c: str = "c") -> DataFrame:
    return df.agg(F.avg(r).alias("r"), F.avg(c).alias("c"))


def histogram_peak(df: DataFrame, r: str, c: str, bin_size: float) -> DataFrame:
    """The fullest bin of a 2-D histogram: bin_r, bin_c, n; ties to the smaller bin."""
    bins = df.groupBy(F.floor(F.col(r) / bin_size).alias("bin_r"), F.floor(F.col(c) / bin_size).alias("bin_c")).agg(F.count("*").alias("n"))
    return bins.orderBy(F.desc("n"), "bin_r", "bin_c").limit(1)


def trimmed_median(values: np.ndarray, most: int = 30, spread: float = 3.0) -> float:
    """Median of what stays within ``spread`` deviations of the mean, again and again until nothing leaves."""
    for _ in range(most):
        kept = values[np.abs(values - values.mean()) <= spread * values.std()]
        if len(kept) == len(values) or not len(kept):
            break
        values = kept
    return float(np.median(values))


def trimmed_medians(df: DataFrame, value: str, by: list[str], most: int = 30, spread: float = 3.0) -> DataFrame:
    """:func:`trimmed_median` of every group of a table: ``by``, median, n (values kept). Nulls and NaN take no part; null keys are a group.

    A round is one aggregate inside the bounds that the rounds before have left; a row a group is kept between rounds.
    """
    keys = [f"_{b}" for b in by]
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    far = float("inf")
    bounds = rows.select(*(F.col(b).alias(k) for b, k in zip(by, keys))).distinct().select(*keys, F.lit(-far).alias("_lo"), F.lit(far).alias("_hi"), F.lit(-1).cast("long").alias("_n"))
    same = reduce(and_, (F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys)))
    for _ in range(most + 1):
        kept = rows.join(bounds, same).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        now = kept.groupBy(*keys, "_lo", "_hi", "_n").agg(F.count("*").alias("now"), F.avg("_v").alias("m"), (F.stddev_pop("_v") * spread).alias("s"))
        now = cut(now.withColumn("more", F.col("now") != F.col("_n")))
        if not now.filter("more").head(1):
            break
        # a group whose last round took nothing away keeps its bounds
        closer = lambda old, new: F.when(F.col("more"), new).otherwise(F.col(old)).alias(old)
        low, high = F.greatest("_lo", F.col("m") - F.col("s")), F.least("_hi", F.col("m") + F.col("s"))
        bounds = now.select(*keys, closer("_lo", low), closer("_hi", high), F.col("now").alias("_n"))
    inside = rows.join(bounds, same).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    return inside.groupBy(*by).agg(F.percentile("_v", F.lit(0.5)).alias("median"), F.count("*").alias("n"))


def transform_columns(r, c, scale: float, degrees: float, centre: tuple[float, float], offset: tuple[float, float]):
    """Rotate about ``centre``, scale, move: two columns (or arrays)."""
    a = np.deg2rad(degrees)
    x, y = r - centre[0], c - centre[1]
    return (
        (x * float(np.cos(a)) - y * float(np.sin(a)) + centre[0]) * scale + offset[0],
        (x * float(np.sin(a)) + y * float(np.cos(a)) + centre[1]) * scale + offset[1],
    )


def apply_affine(df: DataFrame, fit: dict, rc: tuple[str, str], out: tuple[str, str] = ("r_transformed", "c_transformed")) -> DataFrame:
    r, c = transform_columns(F.col(rc[0]), F.col(rc[1]), fit["scale"], fit["degrees"], fit["centre"], fit["offset"])
    return df.withColumns({out[0]: r, out[1]: c})
