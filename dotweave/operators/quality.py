"""Checks of catalogs and configurations, metadata, registration summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.codes import count_code

# What an experiment's configuration must have.
REQUIRED = (
    "Stitching_type", "Experiment_type", "Barcode_length", "Barcode", "Codebooks", "Machine", "Operator",
    "Overlapping_percentage", "Probes_FASTA", "Species", "Start_date", "Strain", "Tissue", "Pipeline",
)
MACHINES = ("ROBOFISH1", "ROBOFISH2", "ROBOFISH3", "NOT-DEFINED")
STITCHING = ("small-beads", "large-beads", "both-beads", "nuclei")
EXPERIMENTS = ("smfish-serial", "smfish-barcoded", "eel-barcoded")
BARCODE_LENGTH = 16


def check_config(config: dict, codebooks: set[str], probes: set[str]) -> list[str]:
    """What is wrong with a configuration; empty if nothing is."""
    found = [f"{k} is missing" for k in REQUIRED if k not in config]
    if found:
        return found
    allowed = {"Machine": MACHINES, "Stitching_type": STITCHING, "Experiment_type": EXPERIMENTS}
    found += [f"{k} is {config[k]!r}" for k, values in allowed.items() if config[k] not in values]
    if "serial" not in config["Experiment_type"]:
        if not config["Codebooks"]:
            found.append("a barcoded experiment needs a codebook")
        found += [f"codebook {b} is missing" for b in (config["Codebooks"] or {}).values() if b != "None" and b not in codebooks]
        if config["Barcode"] not in ("True", "False"):
            found.append("Barcode is neither True nor False")
        elif config["Barcode"] == "True" and config["Barcode_length"] != BARCODE_LENGTH:
            found.append(f"Barcode_length is not {BARCODE_LENGTH}")
    if not config["Probes_FASTA"]:
        found.append("the names of the probes are missing")
    found += [f"probes {p} are missing" for p in (config["Probes_FASTA"] or {}).values() if p != "None" and p not in probes]
    return found


@dataclass(frozen=True)
class Metadata:
    channels: tuple
    fovs: tuple
    rounds: int
    first: dict


def metadata_row(images: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """One row: the distinct ``channels`` and ``fovs``, the number of ``rounds``, and ``columns`` of the first row in ``order``."""
    first = F.min(F.struct(*order, *(c for c in columns if c not in order))).alias("_first")
    row = images.agg(F.sort_array(F.collect_set("channel")).alias("channels"), F.sort_array(F.collect_set("fov_num")).alias("fovs"), F.max("round_num").alias("rounds"), first)
    return row.select("channels", "fovs", "rounds", *(F.col(f"_first.{c}").alias(c) for c in columns))


def metadata(images: DataFrame, order: list[str], columns: list[str]) -> Metadata:
    """:func:`metadata_row` on the driver."""
    row = metadata_row(images, order, columns).first()
    return Metadata(tuple(row["channels"]), tuple(row["fovs"]), row["rounds"], {c: row[c] for c in columns} if row["rounds"] is not None else {})


def worst_registration(dots: DataFrame, by: str, value: str, order: list[str]) -> DataFrame:
    """The row of smallest ``value`` of each group, the first in ``order`` among equals."""
    best = Window.partitionBy(by).orderBy(value, *order)
    return dots.filter(F.col(value).isNotNull()).withColumn("_k", F.row_number().over(best)).filter("_k = 1").drop("_k")


def registration_table(dots: DataFrame) -> DataFrame:
    """fov, round, channel, match count: what an error plot of registrations shows."""
    rows = dots.select("fov_num", "channel", "round_num", "min_number_matching_dots_registration").distinct()
    return worst_registration(rows, "fov_num", "min_number_matching_dots_registration", ["round_num", "channel"])


def duplicate_codes(names: DataFrame, column: str) -> DataFrame:
    """Count codes in ``column`` that occur more than once."""
    return names.select(count_code(F.col(column)).alias("code")).filter("code <> ''").groupBy("code").agg(F.count("*").alias("n")).filter("n > 1")


def unmatched_codes(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Rows of ``left`` whose count code no row of ``right`` has."""
    code = count_code(F.col(column)).alias("code")
    return left.select(column, code).join(right.select(code).distinct(), "code", "left_anti")


def with_partners(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Files of both lists with the same count code."""
    one, two = left.select(F.col(column).alias("left_name"), count_code(F.col(column)).alias("code")), right.select(F.col(column).alias("right_name"), count_code(F.col(column)).alias("code"))
    return one.filter("code <> ''").join(two, "code")


def error_statistics(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean, median, deviation and deviation over n of registration errors."""
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.percentile(value, F.lit(0.5)).alias("median"), F.stddev_pop(value).alias("std"), (F.stddev_pop(value) / F.count(value)).alias("std_by_n")
    )


def status(code: Column) -> Column:
    """The error of a match count in words, null for a usable one."""
    from ..schema import ERRORS

    out = F.lit(None).cast("string")
    for name, number in ERRORS.items():
        out = F.when(code == number, name).otherwise(out)
    return out
