"""Image filters and dot detection, one image a row: numpy inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..schema import PIXELS

BINNING = 100


def to_array(row: pd.Series) -> np.ndarray:
    return np.frombuffer(row["pixels"], row["dtype"]).reshape(tuple(row["shape"]))


def unit(img: np.ndarray) -> np.ndarray:
    return img.astype(np.float64) / 65535 if img.dtype.kind in "ui" else img.astype(np.float64)


def _less_dark(img: np.ndarray, dark: np.ndarray | float) -> np.ndarray:
    return np.maximum(unit(img) - dark, 0)


def _bright_spots(img: np.ndarray, sigma) -> np.ndarray:
    """Minus the Laplacian of Gaussian, without its negative part."""
    return np.maximum(-A.laplace_of_gaussian(img, sigma), 0) + 0.0


def fish(img: np.ndarray, params: dict, dark=0.0) -> np.ndarray:
    """Dark, flat field, spots, projection."""
    img = _less_dark(img, dark)
    return _bright_spots(img / A.gaussian(img, params["PreprocessingFishFlatFieldKernel"]), params["PreprocessingFishFilteringLaplacianKernel"]).max(axis=0)


def fish_normalised(img: np.ndarray, params: dict, dark=0.0) -> np.ndarray:
    """As :func:`fish`, with each plane brought to mean 0 and deviation 1 before the projection."""
    img = _less_dark(img, dark)
    spots = _bright_spots(img / A.gaussian(img, params["PreprocessingFishFlatFieldKernel"]), params["PreprocessingFishFilteringLaplacianKernel"])
    mean, dev = spots.mean(axis=(1, 2), keepdims=True), spots.std(axis=(1, 2), keepdims=True)
    return np.maximum((spots - mean) / dev, 0).max(axis=0)


def without_flat_field(img: np.ndarray, params: dict, dark=0.0) -> np.ndarray:
    """Background subtracted with the spot kernel, then the Laplacian of Gaussian, unturned."""
    kernel = params["PreprocessingFishFilteringLaplacianKernel"]
    img = _less_dark(img, dark)
    return A.laplace_of_gaussian(np.maximum(img - A.gaussian(img, kernel), 0), kernel).max(axis=0)


def without_large_objects(img: np.ndarray, params: dict, dark=0.0) -> tuple[np.ndarray, np.ndarray]:
    """(masked, unmasked): large bright objects of the upper quantile and their surroundings set to zero."""
    img = _less_dark(img, dark)[1:16]
    img = img / (A.gaussian(img, (1, 5, 5), "mirror").min(axis=0) * 0.75)
    img = _bright_spots(img, (0.02, 0.01, 0.01)).max(axis=0)
    found = A.labels(img > np.quantile(img, params.get("LargeObjRemovalPercentile", 95) / 100))
    large = np.bincount(found.ravel()) >= params["LargeObjRemovalMinObjSize"]
    large[0] = False
    return img * ~A.dilate_disk(large[found], params["LargeObjRemovalSelem"]), img


def large_beads(img: np.ndarray, params: dict, dark=0.0) -> np.ndarray:
    """Projection over its own flat field; of a kernel for stacks the part for planes counts."""
    img = _less_dark(img, dark).max(axis=0)
    kernel = params["PreprocessingFishFlatFieldKernel"]
    return img / A.gaussian(img, kernel if np.isscalar(kernel) else tuple(kernel)[-2:])


def nuclei(img: np.ndarray, params: dict, dark=0.0) -> np.ndarray:
    """Smooth background subtracted, projected; the kernel is that of stainings or of fresh nuclei."""
    img = unit(img)
    kernel = params.get("PreprocessingStainingFlatFieldKernel") or params["PreprocessingFreshNucleiLargeKernelSize"]
    return np.maximum(img - A.gaussian(img, kernel), 0).max(axis=0)


#: The filters by the name that a parameter file gives.
FILTERS: dict[str, Callable] = {
    "fish": fish,
    "fish_normalised": fish_normalised,
    "without_flat_field": without_flat_field,
    "without_large_objects": lambda i, p, d=0.0: without_large_objects(i, p, d)[0],
    "large_beads": large_beads,
    "small_beads": fish,
    "both_beads": fish,
    "fresh_beads": fish,
    "nuclei": nuclei,
    "fresh_nuclei": nuclei,
}


def filtered(images: DataFrame, name: str, params: dict, dark: np.ndarray | float = 0.0) -> DataFrame:
    """Raw images (see schema.PIXELS) -> filtered 2-D float64 images."""
    work = FILTERS[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                img = np.ascontiguousarray(work(to_array(row), params, dark), np.float64)
                yield pd.DataFrame([{"fov_num": row["fov_num"], "channel": row["channel"], "round_num": row["round_num"], "shape": list(img.shape), "dtype": "float64", "pixels": img.tobytes()}])

    return images.select(*(x.split()[0] for x in PIXELS.split(", "))).mapInPandas(run, PIXELS)


def dark_image(stack: np.ndarray) -> np.ndarray:
    """The median plane of an empty recording."""
    return np.median(stack, axis=0)


def threshold_curve(img: np.ndarray, min_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds between the smallest non-zero and the largest value, and how many peaks are above each."""
    some = img[img != 0]
    if not len(some):
        return np.zeros(0), np.zeros(0, int)
    at = np.linspace(some.min(), img.max(), BINNING)
    values = np.sort(img[A.local_maxima(img, min_distance)])
    return at, len(values) - np.searchsorted(values, at, "right")


def elbow_threshold(at: np.ndarray, counts: np.ndarray, least: int = 3, stringency: int = 0) -> float | None:
    """The threshold where the falling peak count levels out.

    Thresholds with more than ``least`` peaks count, more than three are needed; from the steepest fall on, the
    one farthest from the chord of the slope is taken, both ends excluded.
    """
    n = int((counts > least).sum())
    if len(counts) <= 3 or n <= 3:
        return None
    slope = np.gradient(counts[counts > least].astype(float))
    low = int(np.argmin(slope))
    x, y = at[:n][low:], slope[low:]
    if len(x) < 3:
        return None
    away = np.abs((x[-1] - x[0]) * (y[0] - y) - (x[0] - x) * (y[-1] - y[0])) / np.hypot(x[-1] - x[0], y[-1] - y[0])
    k = int(np.argmax(away[1:-1]))
    inner = x[1:-1]
    return float(inner[k + stringency] if k + stringency < len(inner) else inner[k])


def detect(img: np.ndarray, min_distance: int, min_size: int, max_size: int, least: int = 3, stringency: int = 0) -> tuple[np.ndarray, float | None]:
    """(row, column) of the dots of an image, and the threshold used: peaks of objects of fitting size."""
    if img.ndim > 2:
        img = img.max(axis=0)
    chosen = elbow_threshold(*threshold_curve(img, min_distance), least, stringency)
    if chosen is None:
        return np.zeros((0, 2), int), None
    found = A.labels(img > chosen)
    size = np.bincount(found.ravel())
    fits = (size >= min_size) & (size <= max_size)
    fits[0] = False
    found = A.labels(fits[found])
    # each object on its own: a pixel is a peak if no pixel of its object in the box around it is larger
    rows = []
    at = np.argwhere(found > 0)
    if len(at):
        inside = ((at >= min_distance) & (at < np.array(img.shape) - min_distance)).all(axis=1)
        for r, c in at[inside]:
            box = slice(r - min_distance, r + min_distance + 1), slice(c - min_distance, c + min_distance + 1)
            if img[r, c] > chosen and img[r, c] >= (img[box] * (found[box] == found[r, c])).max():
                rows.append((r, c))
    return np.array(rows, int).reshape(-1, 2), chosen


_DOTS = "dot_id string, fov_num int, round_num int, channel string, r_px_original double, c_px_original double, dot_intensity double, selected_thr double, mapped_beads_type string"


def dots(images: DataFrame, params: dict) -> DataFrame:
    """Filtered images -> one row per dot; an image without dots gives one row of nulls."""
    args = params["CountingFishMinObjDistance"], params["CountingFishMinObjSize"], params["CountingFishMaxObjSize"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                img = to_array(row)
                rc, chosen = detect(img, *args)
                yield _dot_rows(row, img, rc, chosen, None)

    return images.mapInPandas(run, _DOTS)


def _dot_rows(row: pd.Series, img: np.ndarray, rc: np.ndarray, chosen: float | None, kind: str | None, first: int = 0) -> pd.DataFrame:
    name = f"{row['fov_num']}_{row['round_num']}_{row['channel']}"
    base = {"fov_num": row["fov_num"], "round_num": row["round_num"], "channel": row["channel"]}
    if not len(rc):
        return pd.DataFrame([{"dot_id": None, **base, "r_px_original": None, "c_px_original": None, "dot_intensity": None, "selected_thr": None, "mapped_beads_type": None}]).astype({c: "float64" for c in ("r_px_original", "c_px_original", "dot_intensity", "selected_thr")})
    return pd.DataFrame(
        {
            "dot_id": [f"{name}_{first + i}" for i in range(len(rc))], **{k: [v] * len(rc) for k, v in base.items()}, "r_px_original": rc[:, 0].astype(float), "c_px_original": rc[:, 1].astype(float),
            "dot_intensity": img[rc[:, 0], rc[:, 1]].astype(float), "selected_thr": float(chosen), "mapped_beads_type": [kind] * len(rc),
        }
    )


def beads(images: DataFrame, params: dict, kind: str) -> DataFrame:
    """Large, small or both kinds of beads; of both, large ones are found first and masked before small ones are."""
    large = params["LargeObjMinDistance"], params["LargeObjMinSize"], params["LargeObjMaxSize"]
    small = params["CountingFishMinObjDistance"], params["CountingFishMinObjSize"], params["CountingFishMaxObjSize"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                img, made, first = to_array(row), [], 0
                img = img.max(axis=0) if img.ndim > 2 else img
                if kind in ("large", "both"):
                    rc, chosen = detect(img, *large)
                    made.append(_dot_rows(row, img, rc, chosen, "large"))
                    first = len(rc)
                if kind == "both" and first:
                    found = A.labels(img > np.quantile(img, 0.95))
                    hit = np.unique(found[rc[:, 0], rc[:, 1]])
                    img = img * ~A.dilate_disk(np.isin(found, hit[hit > 0]), params.get("LargeObjRemovalSelem", 3))
                if kind in ("small", "both"):
                    rc, chosen = detect(img, *small)
                    made.append(_dot_rows(row, img, rc, chosen, "small", first))
                full = [m for m in made if m["dot_id"].notna().all()] or made[:1]
                yield pd.concat(full)

    return images.mapInPandas(run, _DOTS)


def from_sparse(pixels: DataFrame, by: list[str], shape: tuple[int, int], dtype: str = "uint16", chunk: tuple[int, int] | None = None) -> DataFrame:
    """``by``, shape, dtype, pixels: one dense image of each group of sparse pixels (r, c, n); absent ones are 0.

    With ``chunk``, images are made in pieces of that size (smaller at the ends), so that no task holds a whole one: ``shape`` is
    the piece's, ``origin`` its place and ``whole`` the image's shape. Pieces without a pixel are left out.
    """
    keys = ", ".join(f"`{b}` {pixels.schema[b].dataType.simpleString()}" for b in by)
    if chunk is None:
        place, more = [], ""
    else:
        place, more = [F.floor(F.col(x) / side).alias(f"_{x}") for x, side in zip(("r", "c"), chunk)], ", origin array<int>, whole array<int>"

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        at = [int(k) * side for k, side in zip(key[len(by) :], chunk)] if chunk else [0, 0]
        size = [min(side, n - o) for side, n, o in zip(chunk or shape, shape, at)]
        img = np.zeros(size, dtype)
        img[group["r"] - at[0], group["c"] - at[1]] = group["n"]
        row = {**{b: group[b].iloc[0] for b in by}, "shape": size, "dtype": dtype, "pixels": img.tobytes()}
        return pd.DataFrame([{**row, "origin": at, "whole": list(shape)} if chunk else row])

    return pixels.groupBy(*by, *place).applyInPandas(run, f"{keys}, shape array<int>, dtype string, pixels binary{more}")


def dark_pixels(pixels: DataFrame, by: tuple[str, ...] = ("channel",), value: str = "value") -> DataFrame:
    """A dark image as rows: the median over all planes of each pixel (``by``, r, c), and the number of planes. Null values take no part."""
    return pixels.groupBy(*by, "r", "c").agg(F.percentile(value, F.lit(0.5)).alias("dark"), F.count(value).alias("planes")).filter("planes > 0")


def without_dark(pixels: DataFrame, dark: DataFrame, by: tuple[str, ...] = ("channel",), value: str = "value") -> DataFrame:
    """``pixels`` less the dark image, nothing below zero; pixels that the dark image lacks are left as they are."""
    level = dark.select(*by, "r", "c", F.col("dark").alias("_dark"))
    return pixels.join(level, [*by, "r", "c"], "left").withColumn(value, F.greatest(F.col(value) - F.coalesce("_dark", F.lit(0.0)), F.lit(0.0))).drop("_dark")
