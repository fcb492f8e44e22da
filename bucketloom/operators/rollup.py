"""The shared aggregation: one row for each bucket, metric and set of dimensions, for all buckets in one plan.

The bucket is projected before the window, so one exchange by (bucket, metric, dimensions) serves both the
counter's ``lag`` and the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import SCHEMA_VERSION, Granularity, SignalSpec


def exact_sum(value: Column, scale: int = 6) -> Column:
    """A sum that doesn't depend on the order of rows."""
    return F.sum(value.cast(f"decimal(28,{scale})")).cast("double")


def with_increase(df: DataFrame, keys: list[str], order: list[str], value: str = "value", counter: Column | None = None) -> DataFrame:
    """Adds ``increase``: each sample's growth over the one before in its group; after a reset its whole value; the first has none."""
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = F.lag(value).over(w)
    grown = F.when(prev.isNull(), F.lit(0.0)).when(F.col(value) >= prev, F.col(value) - prev).otherwise(F.col(value))
    return df.withColumn("increase", F.when(counter, grown).otherwise(F.lit(0.0)) if counter is not None else grown)


def percentile_points(percentiles) -> list[float]:
    """Sorted, each once, as fractions."""
    found = sorted({float(p) for p in percentiles})
    if any(not 0 <= p <= 100 for p in found):
        raise ValueError(f"percentiles outside 0..100: {found}")
    return found


def aggregate(df: DataFrame, keys: list[str], order: list[str], value: str = "value", percentiles=(), counter: Column | None = None) -> DataFrame:
    """count, sum, min, max, first, last, delta, avg and percentiles (p50 ...) by ``keys``."""
    if counter is not None:
        df = with_increase(df, keys, order, value, counter)
    else:
        df = df.withColumn("increase", F.lit(0.0))
    at, points = F.struct(*order), percentile_points(percentiles)
    aggs = [
        F.count(F.lit(1)).alias("count"),
        exact_sum(F.col(value)).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.min_by(value, at).alias("first"),
        F.max_by(value, at).alias("last"),
        exact_sum(F.col("increase")).alias("delta"),
    ]
    if points:
        aggs.append(F.percentile(value, F.array(*[F.lit(p / 100) for p in points])).alias("__p"))
    out = df.groupBy(*keys).agg(*aggs).withColumn("avg", F.col("sum") / F.col("count"))
    for i, p in enumerate(points):
        out = out.withColumn(f"p{p:g}", F.col("__p")[i])
    return out.drop("__p")


def metric_of(spec: SignalSpec) -> Column:
    return {"metrics": F.col("signal_kind"), "logs": F.lit("log_events"), "traces": F.lit("trace_duration_ms")}[spec.name]


def dimension_columns(spec: SignalSpec) -> dict[str, Column]:
    """A typed column for each configured dimension."""
    dims = F.col("dimensions")
    out = {d: X.retained(dims, d, spec.defaults.get(d)) for d in spec.dimensions}
    if spec.name == "logs":
        given = F.coalesce(*[F.nullif(dims[k], F.lit("")) for k in ("severity_text", "detected_level", "level")])
        out["severity_text"] = X.folded_severity(given)
    if spec.name == "traces":
        status = out["status"]
        out["status"] = F.when(status.isin("ok", "error"), status).otherwise(F.raise_error(F.concat(F.lit("unexpected trace status "), status)))
    return out


def rollup(records: DataFrame, spec: SignalSpec, granularity: Granularity) -> DataFrame:
    """Rows in the shape of model.ROLLUP from raw records, for every bucket in them.

    NaN samples are left out: whether they are least or greatest depends on the engine.
    """
    dims = dimension_columns(spec)
    names = [f"d_{d}" for d in dims]
    df = records.where(~F.isnan("value")).select(
        X.bucket_start(F.col("timestamp"), granularity.seconds).alias("bucket_start"),
        metric_of(spec).alias("metric"),
        *[c.alias(f"d_{d}") for d, c in dims.items()],
        "timestamp",
        "identity",
        "value",
    )
    keys = ["bucket_start", "metric", *names]
    counter = X.is_cumulative(F.col("metric")) if spec.name == "metrics" else None
    out = aggregate(df, keys, ["timestamp", "identity"], percentiles=spec.percentiles, counter=counter)
    if spec.name == "metrics":
        extras = {"avg": F.col("avg"), "is_counter": F.when(counter, 1.0).otherwise(0.0)}
    elif spec.name == "logs":
        # The sum is the events, the count the entries that they were collapsed into.
        extras = {"dedup_factor": F.col("sum") / F.col("count"), "is_counter": F.lit(0.0)}
    else:
        extras = {f"p{p:g}": F.col(f"p{p:g}") for p in percentile_points(spec.percentiles)} | {"avg": F.col("avg"), "is_counter": F.lit(0.0)}
    dimensions = X.assembled({d: F.col(f"d_{d}") for d in dims})
    return out.select(
        F.lit(spec.name).alias("signal"),
        F.lit(granularity.name).alias("granularity"),
        F.col("bucket_start").cast("timestamp").alias("bucket_start"),
        "metric",
        dimensions.alias("dimensions"),
        X.dimension_hash(F.col("metric"), dimensions).alias("dimension_hash"),
        "count", "sum", "min", "max", "first", "last", "delta",
        F.create_map(*[x for k in sorted(extras) for x in (F.lit(k), extras[k].cast("double"))]).alias("extras"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
