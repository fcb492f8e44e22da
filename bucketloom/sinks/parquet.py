"""The archive: Parquet by signal, granularity, date and bucket, replaced whole buckets at a time."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import ROLLUP, Granularity, TimeRange

PARTITIONS = ("signal", "granularity", "date", "bucket")


def bucket_path(root: str, signal: str, granularity: str, bucket: TimeRange) -> str:
    return f"{root}/signal={signal}/granularity={granularity}/date={bucket.start:%Y-%m-%d}/bucket={int(bucket.start.timestamp())}"


def write(rows: DataFrame, root: str) -> None:
    """Replaces exactly the buckets that have rows; one sorted file a bucket. A failed job leaves the old buckets."""
    out = rows.withColumn("date", X.date_key(F.col("bucket_start"))).withColumn("bucket", F.unix_seconds("bucket_start"))
    out = out.repartition(*PARTITIONS).sortWithinPartitions(*PARTITIONS, "metric", F.to_json("dimensions"))
    out.write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*PARTITIONS).mode("overwrite").parquet(root)


def write_empty(spark: SparkSession, root: str, signal: str, granularity: Granularity, buckets: list[TimeRange]) -> None:
    """A schema-only file for each sealed bucket without rows, in place of whatever was there. One job makes the file; buckets get copies."""
    if not buckets:
        return
    fields = [f for f in ROLLUP if f.name not in PARTITIONS]
    with staging(spark, root) as place:
        spark.createDataFrame([], type(ROLLUP)(fields)).coalesce(1).write.option("compression", "zstd").parquet(place)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(place).getFileSystem(conf)
        (made,) = [s.getPath() for s in fs.globStatus(path(f"{place}/*.parquet"))]
        for b in buckets:
            to = path(bucket_path(root, signal, granularity.name, b))
            fs.delete(to, True)
            fs.mkdirs(to)
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, made, fs, path(f"{to.toString()}/{made.getName()}"), False, True, conf)


@contextmanager
def staging(spark: SparkSession, root: str):
    """A folder beside the archive's partitions that its readers pass over; it goes at the end."""
    place = f"{root}/_staging/{uuid.uuid4().hex}"
    try:
        yield place
    finally:
        delete([place], spark)


def delete(paths: list[str], spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read(spark: SparkSession, root: str) -> DataFrame:
    schema = type(ROLLUP)([f for f in ROLLUP if f.name not in ("signal", "granularity")])
    full = type(ROLLUP)([*schema, *[f for f in ROLLUP if f.name in ("signal", "granularity")]]).add("date", "string").add("bucket", "long")
    return spark.read.schema(full).parquet(root)


def expire(spark: SparkSession, root: str, granularity: Granularity, before_date: str) -> int:
    """Deletes dates of a granularity that are older than ``before_date``; how many."""
    jvm, n = spark._jvm, 0
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/signal=*/granularity={granularity.name}/date=*"))
    for status in found or []:
        if status.getPath().getName().split("=", 1)[1] < before_date:
            n += bool(fs.delete(status.getPath(), True))
    return n


def files(spark: SparkSession, root: str, granularity: str = "1h") -> DataFrame:
    """signal, bucket_path, bytes of every archive file, empty ones included, from Spark's listing; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path", "length")
    parts = r"^(.*/signal=([^/]+)/granularity=([^/]+)/date=[^/]+/bucket=[^/]+)/[^/]+$"
    out = found.select(*[F.regexp_extract("path", parts, i).alias(c) for i, c in ((1, "bucket_path"), (2, "signal"), (3, "granularity"))], F.col("length").alias("bytes"))
    return out.where(F.col("granularity") == granularity).select("signal", "bucket_path", "bytes")
