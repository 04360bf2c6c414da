"""Session defaults of the library."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What every session should have; sizes of partitions are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "dotweave", **conf: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=DEFAULTS | conf).getOrCreate()
