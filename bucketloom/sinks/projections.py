"""Text projections of rollup rows for hot stores: metric exposition lines and JSON log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketloom import functions as X

#: Begins the name of every projected series; the source selector leaves such names out.
PREFIX = "rollup_"
#: What is projected of counters, and of other rows (fixed values); percentiles come from the rows' extras.
OF_COUNTERS = ("delta", "count")
OF_OTHERS = ("avg", "min", "max", "count")
#: Labels that a projection sets itself.
RESERVED = ("__name__", "tier", "granularity", "rollup_schema", "signal")
_COLUMNS = ("count", "sum", "min", "max", "first", "last", "delta")


def _is_counter() -> Column:
    return F.coalesce(F.col("extras")["is_counter"], F.lit(0.0)) >= 0.5


def long_form(rows: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """A row for each projected aggregate that isn't null: signal, bucket_start, name, aggregate, value, dimensions, granularity, schema_version.

    Extras win over columns of the same name. Every percentile that the rows carry is projected.
    """
    columns = F.create_map(*[x for c in _COLUMNS for x in (F.lit(c), F.col(c).cast("double"))])
    extras = F.col("extras")
    points = F.filter(F.map_keys(extras), lambda k: k.rlike("^p[0-9]"))
    wanted = F.when(_is_counter(), F.array(*map(F.lit, OF_COUNTERS))).otherwise(F.concat(F.array(*map(F.lit, OF_OTHERS)), points))
    out = rows.withColumn("__all", columns).withColumn("aggregate", F.explode(wanted))
    out = out.withColumn("value", F.coalesce(F.col("extras")[F.col("aggregate")], F.col("__all")[F.col("aggregate")]))
    name = F.concat(F.lit(prefix), "metric", F.lit("_"), "aggregate")
    return out.where("value IS NOT NULL").select("signal", "bucket_start", name.alias("name"), "aggregate", "value", "dimensions", "granularity", "schema_version")


def labels(**forced: Column) -> Column:
    """A row's dimensions without reserved ones, with the forced ones, in order."""
    own = X.without(X.canonical(F.col("dimensions")), RESERVED)
    return X.canonical(F.map_concat(own, F.create_map(*[x for k, v in forced.items() for x in (F.lit(k), v.cast("string"))])))


def prometheus_lines(rows: DataFrame, prefix: str = PREFIX, carry: tuple[str, ...] = ()) -> DataFrame:
    """value: exposition lines stamped at the bucket's start; with the rows' columns ``carry``."""
    long = long_form(rows, prefix).withColumn("__labels", labels(tier=F.lit("cold"), granularity=F.col("granularity"), rollup_schema=F.col("schema_version")))
    rendered = F.array_join(F.transform(F.map_entries("__labels"), lambda e: F.concat(e["key"], F.lit('="'), X.escaped_label(e["value"]), F.lit('"'))), ",")
    stamp = F.unix_millis("bucket_start").cast("string")
    return long.select(*carry, F.concat("name", F.lit("{"), rendered, F.lit("} "), F.col("value").cast("string"), F.lit(" "), stamp).alias("value"))


def log_lines(rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """stream (labels), ts_ns and line: one entry a row, compact JSON with its keys in order; with the rows' columns ``carry``."""
    body = F.map_concat(
        F.create_map(*[x for k, c in (("events", "sum"), ("entries", "count"), ("min", "min"), ("max", "max")) for x in (F.lit(k), F.col(c).cast("double"))]),
        F.map_filter("extras", lambda k, v: ~k.isin("events", "entries", "min", "max")),
    )
    fields = F.transform(F.map_entries(body), lambda e: F.struct(e["key"].alias("k"), F.concat(F.lit('"'), e["key"], F.lit('":'), F.coalesce(e["value"].cast("string"), F.lit("null"))).alias("v")))
    start = F.struct(F.lit("bucket_start").alias("k"), F.concat(F.lit('"bucket_start":"'), F.date_format("bucket_start", "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit('"')).alias("v"))
    ordered = F.array_sort(F.concat(fields, F.array(start)))
    line = F.concat(F.lit("{"), F.array_join(F.transform(ordered, lambda x: x["v"]), ","), F.lit("}"))
    stream = labels(tier=F.lit("cold"), signal=F.col("signal"), granularity=F.col("granularity"), rollup_schema=F.col("schema_version"))
    return rows.select(*carry, stream.alias("stream"), (F.unix_seconds("bucket_start") * 1_000_000_000).cast("string").alias("ts_ns"), line.alias("line"))
