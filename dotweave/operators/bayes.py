"""Bayesian barcode calls from per-bit intensities: one kernel density per bit and state.

log p(barcode | x) = sum over bits of log k_bit(x_j) + log prior - log m(x_j), normalised over the candidates;
outside their support densities count as 1e-6. Intensities have unit length, so they lie in [-1, 1]: a histogram of
CELLS cells a bit and state, counted over all rows, is all that a density needs. It uses the Epanechnikov kernel; its
bandwidth is the fixed point of the diffusion estimate (Botev, Grotowski and Kroese, Annals of Statistics 38, 2010) or given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOOR, CELLS = 1e-6, 4096


def roughness(power: np.ndarray, order: int, t: float) -> float:
    """Squared norm of the ``order``-th derivative of a density smoothed for the time ``t``; ``power``: its squared cosine coefficients from the first on."""
    k2 = np.arange(1, len(power) + 1, dtype=float) ** 2
    return float(0.5 * np.pi ** (2 * order) * (k2**order * power * np.exp(-k2 * np.pi**2 * t)).sum())


def diffusion_time(power: np.ndarray, n: int, t: float, stages: int = 7) -> float:
    """The best time for the norm that follows from ``t`` through the stages of the plug-in rule."""
    norm = roughness(power, stages, t)
    for s in range(stages - 1, 1, -1):
        if norm <= 0:
            return np.inf
        moment = np.prod(np.arange(1, 2 * s, 2, dtype=float)) / np.sqrt(2 * np.pi)
        norm = roughness(power, s, ((1 + 0.5 ** (s + 0.5)) / 3 * 2 * moment / (n * norm)) ** (2 / (3 + 2 * s)))
    return (2 * n * np.sqrt(np.pi) * norm) ** -0.4 if norm > 0 else np.inf


def bandwidth(counts: np.ndarray) -> float:
    """Deviation of the kernel in cells: the smallest fixed point of :func:`diffusion_time`, the normal-reference rule where there is none, a cell at least."""
    n, size = int(counts.sum()), len(counts)
    spectrum = np.fft.fft(np.concatenate([counts, counts[::-1]]) / n)[:size]
    power = (spectrum * np.exp(-0.5j * np.pi * np.arange(size) / size)).real[1:] ** 2
    gap = lambda t: t - diffusion_time(power, n, t)
    times = np.geomspace(size**-2.0, 0.1, 60)
    above = next((i for i, t in enumerate(times) if gap(t) >= 0), None)
    if above:
        low, high = times[above - 1], times[above]
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (low, mid) if gap(mid) >= 0 else (mid, high)
        return max(float(np.sqrt(high)) * size, 1.0)
    at = np.arange(size)
    mean = (at * counts).sum() / n
    return max(1.06 * float(np.sqrt(((at - mean) ** 2 * counts).sum() / n)) * n**-0.2, 1.0)


def density(counts: np.ndarray, h: float) -> np.ndarray:
    """The density at the middles of the cells and of one more on either side, for a kernel of deviation ``h`` cells on [-1, 1]."""
    reach = h * np.sqrt(5)
    d = np.arange(-int(np.ceil(reach)), int(np.ceil(reach)) + 1)
    kernel = np.maximum(1 - (d / reach) ** 2, 0)
    return np.convolve(np.pad(counts, 1 + len(d) // 2), kernel, "valid") / (kernel.sum() * counts.sum() * 2 / len(counts))


def look_up(y: np.ndarray | None, x: np.ndarray) -> np.ndarray:
    """A density of :func:`density` between its middles; FLOOR beyond the first and last positive one, or without any."""
    if y is None:
        return np.full(x.shape, FLOOR)
    at = (x + 1) * ((len(y) - 2) / 2) + 0.5  # the first of y is the cell before the interval
    some = np.flatnonzero(y)
    inside = (at >= some[0]) & (at <= some[-1])
    return np.where(inside, np.maximum(np.interp(at, np.arange(len(y)), y), 1e-300), FLOOR)


class BarcodeBayes:
    """Densities of each bit: of all rows, of those whose code has it not, and of those whose code has it."""

    def __init__(self, length: int, tables: dict[tuple[int, str], np.ndarray]):
        self.all, self.off, self.on = ([tables.get((j, state)) for j in range(length)] for state in ("all", "off", "on"))

    def call(self, x: np.ndarray, candidates: np.ndarray, prior: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
        """Index and posterior probability of the best candidate of each spot."""
        logs = lambda tables: np.column_stack([np.log(look_up(y, x[:, j])) for j, y in enumerate(tables)])
        base = logs(self.all)
        off, on = logs(self.off) + np.log(1 - prior) - base, logs(self.on) + np.log(prior) - base
        candidates = candidates.astype(float)
        total = (on - off) @ candidates.T + off.sum(axis=1, keepdims=True)
        top = total.max(axis=1, keepdims=True)
        return total.argmax(axis=1), 1 / np.exp(total - top).sum(axis=1)


def unit_length(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x, dtype=float), where=norm > 0)


def as_bits(codes: np.ndarray, length: int) -> np.ndarray:
    return (codes[:, None] >> np.arange(length)) & 1


def histograms(decoded: DataFrame, length: int, intensity: str = "bit_intensity") -> DataFrame:
    """``bit, state, cell, n``: the unit-length intensities of all rows at most two bits off, by the bits of their observed codes.

    State ``all`` counts every row, ``on`` and ``off`` those with and without the bit. Rows without ``length`` finite intensities take no part.
    """
    v = F.col(intensity)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    unit = F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))
    good = complete(decoded, length, intensity).filter((F.col("hamming_distance") <= 2 / length) & F.col("code_bits").isNotNull())
    bits = good.select("code_bits", F.posexplode(unit).alias("bit", "x"))
    cell = F.least(F.floor((F.col("x") + 1) * (CELLS / 2)), F.lit(CELLS - 1)).cast("int")
    own = F.when(F.getbit("code_bits", F.col("bit")) == 1, "on").otherwise("off")
    return bits.select("bit", F.explode(F.array(F.lit("all"), own)).alias("state"), cell.alias("cell")).groupBy("bit", "state", "cell").agg(F.count(F.lit(1)).alias("n"))


def complete(decoded: DataFrame, length: int, intensity: str) -> DataFrame:
    """The rows with ``length`` finite intensities."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return decoded.filter((F.size(intensity) == length) & F.forall(intensity, finite))


def densities(counted: DataFrame, width: float | None = None) -> DataFrame:
    """``bit, state, h, y``: the density of each histogram (at most CELLS rows); ``width``: the kernel's deviation on [-1, 1], else by diffusion."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.bincount(rows["cell"], rows["n"], CELLS)
        h = width * CELLS / 2 if width else bandwidth(counts)
        return pd.DataFrame([(*key, h * 2 / CELLS, density(counts, h))], columns=["bit", "state", "h", "y"])

    return counted.groupBy("bit", "state").applyInPandas(run, "bit int, state string, h double, y array<double>")


def fit_bayes(decoded: DataFrame, length: int, width: float | None = None, intensity: str = "bit_intensity") -> BarcodeBayes:
    """Densities from all rows; only these come to the driver, three for each bit (100 kB a bit), whatever the number of rows."""
    found = densities(histograms(decoded, length, intensity), width).collect()
    return BarcodeBayes(length, {(r["bit"], r["state"]): np.array(r["y"]) for r in found})


def call_bayes(decoded: DataFrame, model: BarcodeBayes, codebook: list[tuple[str, int]], length: int, least: float = 0.5, intensity: str = "bit_intensity") -> DataFrame:
    """``decoded`` with bayes_gene and probability, rows below ``least`` or without ``length`` finite intensities left out. ``codebook``: (gene, bits)."""
    candidates = as_bits(np.array([b for _, b in codebook], np.int64), length)
    genes = np.array([g for g, _ in codebook], object)
    schema = T.StructType([*decoded.schema, T.StructField("bayes_gene", T.StringType()), T.StructField("probability", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                at, p = model.call(unit_length(np.array(rows[intensity].tolist(), float).reshape(-1, length)), candidates)
                yield rows.assign(bayes_gene=genes[at], probability=p)

    return complete(decoded, length, intensity).mapInPandas(run, schema).filter(F.col("probability") >= least)
