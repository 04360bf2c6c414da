"""File arrivals as a stream: what a polling loop over a folder does, with exactly-once progress in a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_trigger: int = 100, **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.format(kind).load(path)


def process_new(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``work`` once over each batch of files that came since the last call, then stop."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest(stream: DataFrame, target: str, checkpoint: str, by: str = "fov_num") -> StreamingQuery:
    """Append new rows to a stage partitioned by tile."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).partitionBy(by).trigger(availableNow=True).start()


def counts_per_window(stream: DataFrame, time: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Rows per time window and key; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))


def first_arrivals(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each key once, as long as its repeats come within ``late``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
