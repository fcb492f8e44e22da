"""Joins and checks between record sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bucketloom import functions as X


def flagged(rows: DataFrame, errors: DataFrame, key: str) -> DataFrame:
    """``rows`` with status error where the key is among ``errors``' keys, else ok. The planner picks the join's side."""
    marks = errors.select(F.col(key).alias("__key")).distinct().withColumn("__hit", F.lit(True))
    out = rows.join(marks, rows[key] == F.col("__key"), "left")
    return out.withColumn("status", F.when(F.col("__hit"), "error").otherwise("ok")).drop("__key", "__hit")


def members(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return rows.join(other.select(key), key, "left_semi")


def others(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return rows.join(other.select(key), key, "left_anti")


def zipped(df: DataFrame, values: str, stamps: str) -> DataFrame:
    """Arrays of equal length as rows (v, t); a length mismatch fails rather than being padded with nulls."""
    check = F.when(F.size(values) == F.size(stamps), F.arrays_zip(F.col(values).alias("v"), F.col(stamps).alias("t"))).otherwise(
        F.raise_error(F.concat(F.lit("values and timestamps differ in length: "), F.size(values).cast("string"), F.lit(" and "), F.size(stamps).cast("string")))
    )
    return df.withColumn("__pair", F.explode(check)).withColumn("v", F.col("__pair.v")).withColumn("t", F.col("__pair.t")).drop("__pair")


def ordinals(df: DataFrame, series: list[str], ts: str, order: list[str]) -> DataFrame:
    """Numbers samples of one series at one instant from 0, and says how many there are."""
    w = Window.partitionBy(*series, ts)
    return df.withColumn("ordinal", F.row_number().over(w.orderBy(*order)) - 1).withColumn("same_instant", F.count(F.lit(1)).over(w))


def collisions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str], what: str) -> None:
    found = collisions(df, keys).orderBy(F.desc("n"), *keys).limit(5).collect()
    if found:
        raise ValueError(f"{what}: {'; '.join(str(r.asDict()) for r in found)}")


def selected(df: DataFrame, name: Column, dims: Column, prefix: str) -> DataFrame:
    """Leaves out what the rollup itself wrote: by name prefix and by tier; an absent tier isn't cold."""
    return df.where(~F.startswith(name, F.lit(prefix)) & (F.coalesce(dims["tier"], F.lit("")) != "cold"))


def bucket_spine(df: DataFrame, start, end, seconds: int) -> DataFrame:
    """Every bucket of the range, with the rows of ``df`` (bucket_start unique) or nulls."""
    spark = df.sparkSession
    spine = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end) - F.make_dt_interval(secs=F.lit(seconds)), F.make_dt_interval(secs=F.lit(seconds)))).alias("bucket_start"))
    return spine.join(df, "bucket_start", "left")


def drift(records: DataFrame, configured: list[str], ignore: list[str] | None = None) -> DataFrame:
    """kind (missing, unexpected), key and n: configured keys no record has, and keys that aren't configured. Nothing for no records."""
    ignore = ignore or []
    seen = records.select(F.explode(F.map_keys(X.canonical(F.col("dimensions")))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    known = records.sparkSession.createDataFrame([(k,) for k in configured], "key string")
    some = records.limit(1).select(F.lit(True).alias("__some"))
    missing = known.join(seen, "key", "left_anti").crossJoin(F.broadcast(some)).select(F.lit("missing").alias("kind"), "key", F.lit(0).cast("long").alias("n"))
    unexpected = seen.join(known, "key", "left_anti").where(~F.col("key").isin(ignore) if ignore else F.lit(True)).select(F.lit("unexpected").alias("kind"), "key", "n")
    return missing.unionByName(unexpected)


def drift_by_bucket(records: DataFrame, bucket: Column, configured: list[str]) -> DataFrame:
    """bucket, missing (configured keys that no record of the bucket has) and unexpected (the five most frequent others, as n and key), of buckets with either."""
    keys = F.explode_outer(F.map_keys(X.canonical(F.col("dimensions"))))
    seen = records.select(bucket.alias("bucket"), keys.alias("key")).groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.array(*map(F.lit, configured)).cast("array<string>")
    other = F.when(~F.array_contains(wanted, F.col("key")), F.struct("n", "key"))
    out = seen.groupBy("bucket").agg(F.sort_array(F.array_except(wanted, F.collect_set("key"))).alias("missing"), F.slice(F.sort_array(F.collect_list(other), False), 1, 5).alias("unexpected"))
    return out.where((F.size("missing") > 0) | (F.size("unexpected") > 0))


def top_unexpected(report: DataFrame, n: int = 5) -> DataFrame:
    return report.where("kind = 'unexpected'").orderBy(F.desc("n"), "key").limit(n)


def gaps(expected: DataFrame, done: DataFrame, keys: list[str], at: str, seconds: int) -> DataFrame:
    """For each of ``keys``, the frontier: the first expected bucket that isn't done, or the end of the last one."""
    open_ = expected.join(done, [*keys, at], "left_anti").groupBy(*keys).agg(F.min(at).alias("open_start"))
    last = expected.groupBy(*keys).agg((F.max(at) + F.make_dt_interval(secs=F.lit(seconds))).alias("end"))
    return last.join(open_, keys, "left").select(*keys, F.coalesce("open_start", "end").alias("next_start"))
