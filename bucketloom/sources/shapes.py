"""The three backends' response shapes as DataFrames of raw records (model.RAW)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import RAW, TimeRange
from bucketloom.operators import relational as R

# Labels that aren't dimensions (fixed values).
METRIC_NOISE = ("__name__", "job", "instance")
LOG_NOISE = (
    "service_instance_id", "observed_timestamp", "first_observed_timestamp", "last_observed_timestamp", "trace_id", "span_id",
    "flags", "dedup_count", "order_id", "code_file_path", "code_function_name", "code_line_number",
)

EXPORT = "metric map<string,string>, values array<double>, timestamps array<bigint>"
STREAMS = "data struct<resultType: string, result: array<struct<stream: map<string,string>, values: array<array<string>>>>>"
SEARCH = "traces array<struct<traceID: string, rootServiceName: string, rootTraceName: string, startTimeUnixNano: string, durationMs: double>>"


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a malformed one fails the read."""
    return parsed(spark.read.text(path), schema)


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """Lines (value) as rows of the schema. Blank lines go; a line that isn't JSON of the schema's types fails the query."""
    return lines.where(F.trim("value") != "").select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j")).select("j.*")


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def metric_records(series: DataFrame) -> DataFrame:
    """From exported series (EXPORT): unnamed ones go, null and NaN samples go, samples of one instant get ordinals by value.

    The ordinal is a zero-padded number, so that sorting identities as text is sorting them as numbers.
    """
    name = F.col("metric")["__name__"]
    named = series.where(F.coalesce(name, F.lit("")) != "")
    dims = X.canonical(X.without(F.col("metric"), METRIC_NOISE))
    named = named.select(name.alias("signal_kind"), dims.alias("dimensions"), "values", "timestamps")
    named = named.withColumn("key", X.dimension_hash(F.col("signal_kind"), F.col("dimensions")))  # once a series
    samples = R.zipped(named, "values", "timestamps").where(F.col("v").isNotNull() & ~F.isnan("v"))
    samples = R.ordinals(samples, ["key"], "t", ["v"])
    return samples.select(
        F.lit("metrics").alias("signal"),
        X.from_millis(F.col("t")).alias("timestamp"),
        "dimensions",
        F.col("v").alias("value"),
        F.concat_ws(":", "key", F.col("t").cast("string"), F.lpad(F.col("ordinal").cast("string"), 9, "0")).alias("identity"),
        "signal_kind",
    )


def log_records(responses: DataFrame) -> DataFrame:
    """From range queries (STREAMS): a row for each entry; its value is the number of events that it stands for."""
    kind = F.coalesce(F.col("data.resultType"), F.lit("none"))
    checked = F.when(kind == "streams", F.col("data.result")).otherwise(F.raise_error(F.concat(F.lit("expected streams, got "), kind)))
    streams = responses.select(F.explode(checked).alias("s")).select("s.stream", F.explode("s.values").alias("entry"))
    entry = F.when(F.size("entry") >= 2, F.col("entry")).otherwise(F.raise_error(F.lit("log entry without a time or a line")))
    rows = streams.withColumn("entry", entry)
    labels = F.col("stream")
    dims = X.canonical(X.without(labels, LOG_NOISE))
    ns, line = F.element_at("entry", 1), F.element_at("entry", 2)
    return rows.select(
        F.lit("logs").alias("signal"),
        X.from_nanos(ns).alias("timestamp"),
        dims.alias("dimensions"),
        X.positive_int(labels["dedup_count"]).cast("double").alias("value"),
        X.identity(ns, line, F.to_json(F.map_entries(X.canonical(labels)))).alias("identity"),
        F.coalesce(F.nullif(labels["severity_text"], F.lit("")), F.nullif(labels["detected_level"], F.lit(""))).alias("signal_kind"),
    )


def trace_records(found: DataFrame, errored: DataFrame) -> DataFrame:
    """From two searches (SEARCH), all traces and the errored ones; traces without an id or a start go, a missing duration is 0."""
    flat = found.select(F.explode("traces").alias("t")).select("t.*").where(F.coalesce("traceID", F.lit("")) != "").where(F.coalesce("startTimeUnixNano", F.lit("")) != "")
    bad = errored.select(F.explode("traces").alias("t")).select("t.traceID").where("traceID IS NOT NULL")
    rows = R.flagged(flat, bad, "traceID")
    dims = F.create_map(F.lit("root_service_name"), F.col("rootServiceName"), F.lit("root_name"), F.col("rootTraceName"), F.lit("status"), F.col("status"))
    return rows.select(
        F.lit("traces").alias("signal"),
        X.from_nanos(F.col("startTimeUnixNano")).alias("timestamp"),
        X.canonical(dims).alias("dimensions"),
        F.coalesce("durationMs", F.lit(0.0)).alias("value"),
        F.col("traceID").alias("identity"),
        F.lit("trace").alias("signal_kind"),
    )


def within(records: DataFrame, window: TimeRange) -> DataFrame:
    """Half-open, whatever the backend returned."""
    return records.where(X.in_range(F.col("timestamp"), window.start, window.end))


def archived(spark: SparkSession, path: str) -> DataFrame:
    """Raw records kept as Parquet in the shape of model.RAW."""
    return spark.read.schema(RAW).parquet(path)
