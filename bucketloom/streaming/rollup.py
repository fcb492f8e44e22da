"""Continuous rollup with Structured Streaming.

A bucket is emitted once the watermark (the largest event time less the grace) reaches its end, the batch run's seal rule with
event time in place of the wall clock: a quiet source doesn't advance it. Later records are dropped. ``lag`` isn't allowed on
streams, so increases are folded over each group's samples in time order; state holds the samples of open buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import SCHEMA_VERSION, Granularity, SignalSpec
from bucketloom.operators.rollup import dimension_columns, exact_sum, metric_of, percentile_points
from bucketloom.sinks import parquet


def increase_of(samples: Column) -> Column:
    """The growth over an array of structs (timestamp, identity, value), resets as in operators.rollup."""
    ordered = F.array_sort(samples)
    start = F.struct(F.lit(None).cast("double").alias("prev"), F.lit(0.0).alias("total"))

    def step(acc: Column, s: Column) -> Column:
        v, p = s["value"], acc["prev"]
        grown = F.when(p.isNull(), 0.0).when(v >= p, v - p).otherwise(v)
        return F.struct(v.alias("prev"), (acc["total"] + grown).alias("total"))

    return F.aggregate(ordered, start, step, lambda acc: F.round(acc["total"], 6))


def rollup_stream(records: DataFrame, spec: SignalSpec, granularity: Granularity) -> DataFrame:
    """Rows in the shape of model.ROLLUP, from a stream of raw records."""
    dims = dimension_columns(spec)
    names = [f"d_{d}" for d in dims]
    df = records.where(~F.isnan("value")).withWatermark("timestamp", f"{int(spec.grace.total_seconds())} seconds")
    df = df.select("timestamp", "identity", "value", metric_of(spec).alias("metric"), *[c.alias(f"d_{d}") for d, c in dims.items()])
    at, points = F.struct("timestamp", "identity"), percentile_points(spec.percentiles)
    aggs = [
        F.count("*").alias("count"), exact_sum(F.col("value")).alias("sum"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.min_by("value", at).alias("first"), F.max_by("value", at).alias("last"),
    ]
    if spec.name == "metrics":
        aggs.append(F.collect_list(F.struct("timestamp", "identity", "value")).alias("samples"))
    if points:
        aggs.append(F.percentile("value", F.array(*[F.lit(p / 100) for p in points])).alias("points"))
    out = df.groupBy(F.window("timestamp", f"{granularity.seconds} seconds").alias("w"), "metric", *names).agg(*aggs)
    counter = X.is_cumulative(F.col("metric")) if spec.name == "metrics" else F.lit(False)
    delta = F.when(counter, increase_of(F.col("samples"))).otherwise(0.0) if spec.name == "metrics" else F.lit(0.0)
    avg = F.col("sum") / F.col("count")
    extras = {"is_counter": F.when(counter, 1.0).otherwise(0.0)} | ({"dedup_factor": avg} if spec.name == "logs" else {"avg": avg})
    extras |= {f"p{p:g}": F.col("points")[i] for i, p in enumerate(points)}
    dimensions = X.assembled({d: F.col(f"d_{d}") for d in dims})
    return out.select(
        F.lit(spec.name).alias("signal"), F.lit(granularity.name).alias("granularity"), F.col("w.start").alias("bucket_start"), "metric", dimensions.alias("dimensions"),
        X.dimension_hash(F.col("metric"), dimensions).alias("dimension_hash"), "count", "sum", "min", "max", "first", "last", delta.alias("delta"),
        F.create_map(*[x for k in sorted(extras) for x in (F.lit(k), extras[k].cast("double"))]).alias("extras"), F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def start(records: DataFrame, spec: SignalSpec, granularity: Granularity, root: str, checkpoint: str, **trigger):
    """Writes sealed buckets to the archive. A bucket is emitted once, whole, so a batch that runs again replaces the same buckets."""
    rows = rollup_stream(records, spec, granularity)
    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).foreachBatch(lambda df, _: parquet.write(df, root)).start()
