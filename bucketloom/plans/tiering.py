"""Tiering: what backends keep, whether raw data outlives its rollup, and how much the archive saves."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import SPECS, Granularity
from bucketloom.sinks import parquet
from bucketloom.sources.http import SourceError, get

#: Trace blocks' retention where the backend doesn't tell (a fixed value).
TRACES_HOT = timedelta(hours=24)
MARGIN = timedelta(hours=2)


def parse_duration(text: str | None) -> timedelta | None:
    """A setting's duration, by the pattern and units of ``functions.duration_seconds``."""
    m = re.fullmatch(X.DURATION, text or "")
    return timedelta(seconds=float(m[1]) * X.UNITS[m[2].lower()]) if m else None


def metrics_retention(flags: str) -> tuple[str | None, bool]:
    """The retention flag's value in exposition text, and whether retention filters are set."""
    m = re.search(r'retentionPeriod",\s*value="([^"]+)"', flags)
    return (m[1] if m else None), 'name="retentionFilters"' in flags


def logs_retention(config: str) -> tuple[str | None, str | None]:
    """The general retention and that of the rule for the cold tier, from configuration text."""
    hot = re.search(r"^\s*retention_period:\s*(\S+)", config, re.M)
    rules = re.search(r"retention_stream:\s*\n((?:[ \t]+(?:-|\w+:).*(?:\n|\Z))+)", config)
    cold = None
    for rule in re.split(r"(?m)^\s+-", rules[1]) if rules else ():
        period = re.search(r"\bperiod:\s*(\S+)", rule)
        if "cold" in rule and period:
            cold = period[1]
    return (hot[1] if hot else None), cold


def probe(spark: SparkSession, metrics_url: str | None, logs_url: str | None) -> DataFrame:
    """backend, hot and cold (seconds), can_tier, of each backend as it runs; null where it couldn't be read."""

    def text(url: str | None, path: str) -> str:
        try:
            return get(url, path, {}).decode() if url else ""
        except SourceError:
            return ""

    seconds = lambda x: int(d.total_seconds()) if (d := parse_duration(x)) is not None else None
    hot, filters = metrics_retention(text(metrics_url, "/metrics"))
    log_hot, log_cold = logs_retention(text(logs_url, "/config"))
    rows = [
        ("metrics", seconds(hot), seconds(hot), filters),
        ("logs", seconds(log_hot), seconds(log_cold), log_cold is not None),
        ("traces", int(TRACES_HOT.total_seconds()), None, False),
    ]
    return spark.createDataFrame(rows, "signal string, hot long, cold long, can_tier boolean")


def safety(retentions: DataFrame, granularity: Granularity, margin: timedelta = MARGIN, count_width: bool = False) -> DataFrame:
    """Adds required and safe. The worst grace counts for all; ``count_width`` adds the bucket's own width, without which long buckets lose their oldest part."""
    grace = max(int(s.grace.total_seconds()) for s in SPECS.values())
    interval = 3600
    required = grace + interval + int(margin.total_seconds()) + (granularity.seconds if count_width else 0)
    safe = X.is_safe(F.col("hot"), F.lit(grace), F.lit(interval), F.lit(int(margin.total_seconds())), granularity.seconds if count_width else 0)
    return retentions.withColumn("required", F.lit(required)).withColumn("safe", safe)


def ratio(spark: SparkSession, root: str, granularity: str = "1h") -> DataFrame:
    """By signal and in total: files, empty ones and their bytes, cold bytes, rows, raw records, reduction, bytes per 1000 raw records."""
    listed = parquet.files(spark, root, granularity)
    rows = parquet.read(spark, root).where(F.col("granularity") == granularity)
    path = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*/bucket=[^/]+)/", 1)
    per_file = rows.select(path.alias("path"), "count").groupBy("path").agg(F.count("*").alias("n"), F.sum("count").alias("raw"))
    per_file = per_file.withColumn("path", F.regexp_replace("path", "^file:/*", "/"))
    listed = listed.withColumn("path", F.regexp_replace("bucket_path", "^file:/*", "/"))
    both = listed.join(per_file, "path", "left").fillna(0, ["n", "raw"])
    empty = F.col("n") == 0
    out = both.rollup("signal").agg(
        F.count("*").alias("files"), F.sum(empty.cast("long")).alias("empty_files"), F.sum(F.when(empty, F.col("bytes")).otherwise(0)).alias("empty_bytes"),
        F.sum("bytes").alias("cold_bytes"), F.sum("n").alias("rows"), F.sum("raw").alias("raw"),
    )
    return out.select(
        F.coalesce("signal", F.lit("total")).alias("signal"), "files", "empty_files", "empty_bytes", "cold_bytes", "rows", "raw",
        (F.col("raw") / F.nullif("rows", F.lit(0))).alias("reduction"), (F.col("cold_bytes") * 1000 / F.nullif("raw", F.lit(0))).alias("bytes_per_1000"),
    )
