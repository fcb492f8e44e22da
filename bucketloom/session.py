"""A session with the settings that the engine's semantics need."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps NTZ and LTZ buckets aligned; dynamic overwrite replaces only the buckets that a write touches.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(app: str = "bucketloom", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
