"""The stages of an experiment as one object: each stage reads its predecessor's Parquet folder and writes its own.

A stage that was written before is not computed again unless ``restart`` names it or one before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import barcodes, cells, dedup, geometry, images, registration, selection
from ..sources import catalogs


@dataclass
class Settings:
    machine: str
    pixel_microns: float
    image_size: int
    rounds: int
    bead_channel: str
    reference_round: int = 1
    tolerance: float = 3.0
    least_matches: int = 5
    resolution: float = 3.0
    same_dot_radius: float = 10.0
    barcode_length: int = barcodes.LENGTH
    fish_filter: str = "fish"
    bead_filter: str = "large_beads"
    parameters: dict = field(default_factory=dict)


class Experiment:
    """A barcoded (or, with ``codebook`` None, serial) experiment in a folder."""

    ORDER = ("dots", "shifts", "registered", "decoded", "stitched", "global_tiles", "restitched", "cleaned", "assigned")

    def __init__(self, spark: SparkSession, folder: str, settings: Settings, catalog: DataFrame, pixels: DataFrame, codebook: DataFrame | None, mask: DataFrame | None = None):
        self.spark, self.folder, self.s = spark, folder.rstrip("/"), settings
        self.catalog, self.pixels, self.codebook, self.mask = catalog, pixels, codebook, mask

    def path(self, stage: str) -> str:
        return f"{self.folder}/{stage}"

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def done(self, stage: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(stage) + "/_SUCCESS")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def tiles(self) -> DataFrame:
        return geometry.tile_corners(geometry.stage_coordinates(self.catalog, self.s.reference_round), self.s.machine, self.s.pixel_microns)

    def overlaps(self, tiles: DataFrame) -> DataFrame:
        size = self.s.image_size
        return geometry.overlaps(tiles, geometry.adjacent(tiles, size), geometry.CORNERS[self.s.machine], size, size)

    # stages
    def dots(self) -> DataFrame:
        beads = F.col("channel") == self.s.bead_channel
        fish = images.dots(images.filtered(self.pixels.filter(~beads), self.s.fish_filter, self.s.parameters), self.s.parameters)
        return fish.unionByName(images.beads(images.filtered(self.pixels.filter(beads), self.s.bead_filter, self.s.parameters), self.s.parameters, "large"))

    def shifts(self) -> DataFrame:
        beads = self.read("dots").filter(F.col("channel") == self.s.bead_channel)
        return registration.round_shifts(beads, self.s.reference_round, self.s.rounds, (self.s.image_size, self.s.image_size), self.s.tolerance, self.s.least_matches)

    def registered(self) -> DataFrame:
        dots, shifts = self.read("dots"), self.read("shifts")
        beads = F.col("channel") == self.s.bead_channel
        return registration.register(dots.filter(beads), shifts, least=self.s.least_matches).unionByName(registration.register(dots.filter(~beads), shifts))

    def decoded(self) -> DataFrame:
        fish = self.read("registered").filter((F.col("channel") != self.s.bead_channel) & F.col("r_px_registered").isNotNull())
        if self.codebook is None:  # serial: the channel's target of that round is the gene
            return fish.join(self.catalog.select("fov_num", "channel", "round_num", F.col("target_name").alias("decoded_genes")), ["fov_num", "channel", "round_num"]).select(
                "fov_num", "channel", F.col("dot_id").alias("barcode_reference_dot_id"), "round_num", F.col("r_px_registered").alias("r"), F.col("c_px_registered").alias("c"), "decoded_genes", F.lit(0.0).alias("hamming_distance")
            )
        return barcodes.nearest_codeword(barcodes.decode(fish, self.s.resolution, self.s.barcode_length), self.codebook, self.s.barcode_length)

    def stitched(self) -> DataFrame:
        return geometry.stitch(self.read("decoded"), self.tiles(), geometry.CORNERS[self.s.machine], self.s.image_size, self.s.image_size, ("r", "c"))

    def global_tiles(self) -> DataFrame:
        corner, size = geometry.CORNERS[self.s.machine], self.s.image_size
        tiles = self.tiles()
        beads = self.read("registered").filter((F.col("channel") == self.s.bead_channel) & F.col("r_px_registered").isNotNull())
        placed = geometry.stitch(beads, tiles, corner, size, size).select("fov_num", F.col("r_px_microscope_stitched").alias("r"), F.col("c_px_microscope_stitched").alias("c"))
        return registration.global_offsets(registration.pair_shifts(placed, self.overlaps(tiles), self.s.tolerance), tiles)

    def restitched(self) -> DataFrame:
        corner, size = geometry.CORNERS[self.s.machine], self.s.image_size
        return geometry.stitch(self.read("stitched"), self.read("global_tiles"), corner, size, size, ("r", "c"), "global_stitched")

    def cleaned(self) -> DataFrame:
        dots, rc = self.read("restitched"), ("r_px_global_stitched", "c_px_global_stitched")
        key = "barcode_reference_dot_id"
        twice = dedup.duplicated(dots, self.overlaps(self.read("global_tiles")), self.s.same_dot_radius, rc, "decoded_genes", key)
        return dedup.split_by(dots, twice, key)[0]

    def assigned(self) -> DataFrame:
        dots = self.read("cleaned")
        if self.mask is None:
            return dots.withColumn("cell_id", F.lit(-1).cast("bigint"))
        return cells.assign(dots, self.mask, ("r_px_global_stitched", "c_px_global_stitched"), "barcode_reference_dot_id")

    def run(self, until: str = "assigned", restart: str | None = None) -> DataFrame:
        """Write the stages up to ``until`` that are not there yet, all from ``restart`` on anew; return the last."""
        fresh = False
        for name in self.ORDER[: self.ORDER.index(until) + 1]:
            fresh = fresh or name == restart or not self.done(name)
            if fresh:
                work: Callable[[], DataFrame] = getattr(self, name)
                work().write.mode("overwrite").parquet(self.path(name))
        return self.read(until)

    def gene_counts(self, most: float = 3 / 16) -> DataFrame:
        good = selection.valid_rna(self.read("assigned"), self.s.bead_channel, most)
        return cells.gene_counts(good, "decoded_genes")

    def write_matrix(self, path: str) -> None:
        counts = self.gene_counts()
        catalogs.write_matrix(counts, counts.select("cell_id").distinct(), {"machine": self.s.machine}, path, "decoded_genes")
