"""Reading catalogs, images, codebooks and configurations; writing stages and count matrices.

Everything goes through Spark's readers and writers, so any store that Spark reaches will do. Formats that need
libraries beyond the installed ones (microscope vendor files, spreadsheets, Loom) have a documented counterpart:
pixels as Parquet rows or chunk files, codebooks as CSV or Parquet, count matrices as three Parquet tables.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import count_code, none_to_null, pack_bits, parse_codeword, round_of
from ..schema import IMAGES, PIXELS


def stage(spark: SparkSession, path: str, columns: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    """A stage's Parquet folder (partitioned by fov_num), or the files of it that match a glob; ``columns`` reach the scan."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true") if pattern else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def write_stage(df: DataFrame, path: str, by: str = "fov_num") -> None:
    """One folder per tile: selections by tile become partition pruning, and a finished stage is where a restart begins."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def zarr_catalog(spark: SparkSession, metadata_path: str) -> DataFrame:
    """The catalog (schema.IMAGES) from consolidated array metadata: one row per group that has attributes."""
    fields = {f.name: f.dataType for f in spark.createDataFrame([], IMAGES).schema.fields}
    text = spark.read.option("wholetext", "true").text(metadata_path)
    attrs = text.select(F.explode(F.from_json(F.get_json_object("value", "$.metadata"), "map<string,string>")).alias("path", "body")).filter(F.col("path").endswith(".zattrs"))
    values = attrs.select(F.regexp_replace("path", r"/?\.zattrs$", "").alias("grp"), F.from_json("body", "map<string,string>").alias("m")).filter(F.size("m") > 0)
    column = lambda n, t: (none_to_null(F.col("m")[n])).cast(t).alias(n)
    return values.select(*(F.coalesce(column(n, t), F.col("grp")).alias(n) if n == "grp_name" else column(n, t) for n, t in fields.items()))


def json_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog of one JSON object per image."""
    return spark.read.schema(IMAGES).json(path)


def raw_pixels(spark: SparkSession, path: str, dtype: str = "uint16") -> DataFrame:
    """Uncompressed chunk files ``<fov>_<channel>_<round>_<z>x<rows>x<cols>.raw`` as rows of schema.PIXELS."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.raw").load(path)
    part = lambda i, kind: F.regexp_extract("path", r"([^/_]+)_([^/_]+)_(\d+)_(\d+)x(\d+)x(\d+)\.raw$", i).cast(kind)
    return files.select(
        part(1, "int").alias("fov_num"), part(2, "string").alias("channel"), part(3, "int").alias("round_num"),
        F.array(part(4, "int"), part(5, "int"), part(6, "int")).alias("shape"), F.lit(dtype).alias("dtype"), F.col("content").alias("pixels"),
    )


def sparse_pixels(images: DataFrame) -> DataFrame:
    """fov_num, channel, round_num, pr, pc, value of the non-zero pixels of 2-D images."""
    schema = "fov_num int, channel string, round_num int, pr int, pc int, value double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                img = np.frombuffer(row["pixels"], row["dtype"]).reshape(tuple(row["shape"]))
                r, c = np.nonzero(img)
                yield pd.DataFrame({"fov_num": row["fov_num"], "channel": row["channel"], "round_num": row["round_num"], "pr": r.astype("int32"), "pc": c.astype("int32"), "value": img[r, c].astype(float)})

    return images.select(*(x.split()[0] for x in PIXELS.split(", "))).mapInPandas(run, schema)


def parsed_files(files: DataFrame, side_files: DataFrame, stitching_channel: str) -> DataFrame:
    """Recordings (path, channel, target_name) with their side file by count code, round number and processing type."""
    sides = side_files.select(F.col("path").alias("side_path"), count_code(F.col("path")).alias("code"))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    kind = F.when(F.col("channel") == stitching_channel, F.lit("beads")).when(F.col("target_name").contains("nuclei") | (F.col("channel") == "DAPI"), F.lit("nuclei")).otherwise(F.lit("fish"))
    number = F.when(name.contains("Hybridization"), round_of(F.regexp_extract(name, r"(Hybridization\d+)", 1)))
    return files.withColumn("code", count_code(F.col("path"))).join(sides, "code", "left").withColumns({"round_num": number, "processing_type": kind})


def codebook(df: DataFrame, code: str = "Barcode", gene: str = "Gene", channel: str | None = None) -> DataFrame:
    """channel, gene, code, code_bits, code_idx (the order of the book, by gene) from '[0101...]' strings."""
    made = df.select(F.lit(channel).cast("string").alias("channel"), F.col(gene).alias("gene"), parse_codeword(F.col(code)).alias("code"))
    from pyspark.sql.window import Window

    # a codebook has some hundred rows
    return made.withColumns({"code_bits": pack_bits(F.col("code")), "code_idx": F.row_number().over(Window.orderBy("gene")) - 1})


def codebooks(spark: SparkSession, images: DataFrame, folder: str) -> DataFrame:
    """The codebooks that the catalog names, by its (channel, codebook) pairs; the name 'None' means none."""
    pairs = images.select("channel", none_to_null(F.col("codebook")).alias("codebook")).dropna().distinct().collect()
    out = None
    for p in pairs:
        one = codebook(spark.read.parquet(f"{folder}/{p['codebook']}"), channel=p["channel"])
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "channel string, gene string, code array<tinyint>, code_bits long, code_idx int")


def config(spark: SparkSession, path: str) -> dict:
    """A YAML or JSON document, read by Spark."""
    text = spark.read.option("wholetext", "true").text(path).first()["value"]
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def parameters(settings: dict, experiment: str, machine: str, processing: str) -> dict:
    """The parameters of one kind of image: settings[experiment][machine][processing]."""
    try:
        return dict(settings[experiment][machine][processing])
    except KeyError as missing:
        raise ValueError(f"no parameters for {missing.args[0]!r}") from None


def write_config(spark: SparkSession, settings: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(settings, indent=1, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_matrix(counts: DataFrame, cells: DataFrame, attributes: dict, path: str, gene: str = "gene", cell: str = "cell_id") -> None:
    """A count matrix in long form: counts, genes, cells (with TotalMolecules) and file attributes."""
    totals = counts.groupBy(cell).agg(F.sum("n").alias("TotalMolecules"))
    counts.select(F.col(gene).alias("Gene"), F.col(cell).alias("CellID"), "n").write.mode("overwrite").parquet(f"{path}/counts")
    cells.join(totals, cell, "left").withColumn("TotalMolecules", F.coalesce("TotalMolecules", F.lit(0))).withColumnRenamed(cell, "CellID").write.mode("overwrite").parquet(f"{path}/cells")
    counts.groupBy(F.col(gene).alias("Gene")).agg(F.sum("n").alias("Total")).write.mode("overwrite").parquet(f"{path}/genes")
    counts.sparkSession.createDataFrame([(k, str(v)) for k, v in attributes.items()], "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/attributes")


def finite(value: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(F.isnan(value) | (F.abs(value) == math.inf), F.lit(None)).otherwise(value)
