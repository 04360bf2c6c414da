"""Catalog selections, validity filters and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fov_range(df: DataFrame, low: int, high: int, fov: str = "fov_num") -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(fov).between(low, high))


def channel(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("channel") == name)


def one_round(df: DataFrame, number: int) -> DataFrame:
    return df.filter(F.col("round_num") == number)


def one_image(df: DataFrame, channel_name: str, round_num: int, fov_num: int) -> DataFrame:
    """All rows of one image; more than one where the catalog repeats it."""
    return df.filter((F.col("channel") == channel_name) & (F.col("round_num") == round_num) & (F.col("fov_num") == fov_num))


def fov_list(df: DataFrame, fovs: DataFrame | list, fov: str = "fov_num") -> DataFrame:
    """A list of numbers becomes a predicate that reaches the scan; a table, a semi-join."""
    return df.join(fovs.select(fov), fov, "left_semi") if isinstance(fovs, DataFrame) else df.filter(F.col(fov).isin(fovs))


def not_processed(df: DataFrame, processed: DataFrame, fov: str = "fov_num") -> DataFrame:
    """What a resumed run still has to do."""
    return df.join(processed.select(fov), fov, "left_anti")


def every(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def in_box(r: Column, c: Column, box: tuple[Column, Column, Column, Column], strict: bool) -> Column:
    """Inside (r_tl, r_br, c_tl, c_br): without the edges if ``strict``."""
    r0, r1, c0, c1 = box
    return (r > r0) & (r < r1) & (c > c0) & (c < c1) if strict else r.between(r0, r1) & c.between(c0, c1)


def interior(df: DataFrame, r: str, c: str, border: float, frame: float = 2048, most_distance: float = 2 / 16, distance: str = "hamming_distance") -> DataFrame:
    """Decoded dots strictly inside the border of their frame, of at most ``most_distance``."""
    low, high = F.lit(float(border)), F.lit(float(frame - border))
    return df.filter(in_box(F.col(r), F.col(c), (low, high, low, high), True) & (F.col(distance) <= most_distance))


def valid_rna(df: DataFrame, bead_channel: str, below: float, distance: str = "hamming_distance") -> DataFrame:
    return df.filter((F.col("channel") != bead_channel) & (F.col(distance) < below))


def large_beads(df: DataFrame, bead_channel: str, coords: list[str]) -> DataFrame:
    chosen = (F.col("channel") == bead_channel) & (F.col("mapped_beads_type") == "large") & (F.col("round_num") == 1)
    return df.filter(chosen).dropna(subset=coords)


def flip_candidates(df: DataFrame, channel_name: str, length: int) -> DataFrame:
    """Self-referring dots whose code is off by one or two bits."""
    own = F.col("dot_id") == F.col("barcode_reference_dot_id")
    return df.filter(own & (F.col("channel") == channel_name) & (F.col("hamming_distance") > 0) & (F.col("hamming_distance") < 3 / length))


def plotting_extract(df: DataFrame, threshold: float, columns: list[str], gene: str = "decoded_genes", distance: str = "hamming_distance") -> DataFrame:
    """Exact codes only at threshold 0, else those strictly below it; without null genes."""
    good = F.col(distance) == 0 if threshold == 0 else F.col(distance) < threshold
    return df.filter(good).select(*columns).dropna(subset=[gene])


def serial_extract(df: DataFrame, columns: list[str], target: str = "target_name") -> DataFrame:
    """Plotting columns of serial rounds: rows that have a target."""
    return df.select(*columns).dropna(subset=[target])


def any_null(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Groups and whether any value of ``column`` is null."""
    return df.groupBy(*by).agg(F.max(F.col(column).isNull()).alias("has_null"))


def overwrite(df: DataFrame, values: dict[str, object], where: Column | None = None) -> DataFrame:
    """Literal values for columns, everywhere or ``where`` a condition holds."""
    return df.withColumns({k: F.lit(v) if where is None else F.when(where, F.lit(v)).otherwise(F.col(k)) for k, v in values.items()})


def with_dot_id(df: DataFrame, order: list[str]) -> DataFrame:
    """``dot_id``: fov, round, channel and the running number in ``order``, from 0."""
    by = ["fov_num", "round_num", "channel"]
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return df.withColumn("dot_id", F.concat_ws("_", *(F.col(x).cast("string") for x in by), number.cast("string")))


def with_metadata(dots: DataFrame, images: DataFrame) -> DataFrame:
    """Dots with the metadata of their image."""
    return dots.join(images, ["fov_num", "channel", "round_num"], "left")


def union_outer(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def singletons(df: DataFrame, matched: DataFrame, key: str = "dot_id") -> DataFrame:
    return df.join(matched.select(key), key, "left_anti")


def first_of(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """One row per key, the first in an explicit order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_k = 1").drop("_k")


def batches(df: DataFrame, key: str, size: int, total: int) -> DataFrame:
    """Keys of 0..total with the chunk they fall in; the remainder joins the last full chunk."""
    return df.withColumn("chunk", F.least(F.floor(F.col(key) / size), F.lit(max(total // size - 1, 0))))
