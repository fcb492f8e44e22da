"""Registered queries of the sources and sinks: backend answers built from ``events``, parsed as they would be; rows projected, archived and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import DAY, SPECS, Granularity
from bucketloom.operators import rollup as A
from bucketloom.plans.catalogue import HOUR, LOGS, METRICS, POINTS, TRACES, _sql_metrics, events, query, raw_records, sql_sum
from bucketloom.plans.tiering import ratio
from bucketloom.sinks import parquet, projections
from bucketloom.sources import shapes

DAILY, HOURLY = Granularity("1d", DAY), Granularity("1h", HOUR)


def _scratch(spark) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{base.rstrip('/')}/loom-{uuid.uuid4().hex}" if base else tempfile.mkdtemp(prefix="loom-")


def _nanos():
    """Nanoseconds as text, beyond the microseconds that a timestamp holds."""
    return F.concat(F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))


def _responses(df, body):
    """One JSON answer a row, in one column."""
    return df.select(F.to_json(body).alias("value"))


@query("""WITH s AS (SELECT event_type || '_total' AS signal_kind, '/' || CAST(user_id % 4 AS VARCHAR) AS route, date_trunc('minute', ts) AS "timestamp",
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events WHERE event_type <> 'error')
SELECT signal_kind, route, CAST(1 AS INTEGER) AS n_dims, "timestamp", value, row_number() OVER (PARTITION BY signal_kind, route, "timestamp" ORDER BY value) - 1 AS ordinal FROM s WHERE value IS NOT NULL""")
def metric_export_records(spark, d):
    """Exported series: unnamed ones and null samples go, dropped labels too, samples of one instant are numbered."""
    name = F.when(F.col("event_type") != "error", F.concat("event_type", F.lit("_total")))
    minute = F.unix_millis(F.date_trunc("minute", F.col("ts").cast("timestamp")))
    s = events(spark, d).select(
        name.alias("name"), F.concat(F.lit("/"), (F.col("user_id") % 4).cast("string")).alias("route"), X.bucket_start(F.col("ts"), HOUR).alias("hour"),
        F.struct(minute.alias("t"), F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("v")).alias("sample"),
    )
    s = s.groupBy("name", "route", "hour").agg(F.collect_list("sample").alias("s"))
    metric = F.create_map(F.lit("__name__"), F.col("name"), F.lit("job"), F.lit("j"), F.lit("instance"), F.lit("i"), F.lit("route"), F.col("route"), F.lit("zone"), F.lit(""))
    answers = _responses(s, F.struct(metric.alias("metric"), F.col("s.v").alias("values"), F.col("s.t").alias("timestamps")))
    r = shapes.metric_records(shapes.parsed(answers, shapes.EXPORT))
    return r.select(
        "signal_kind", F.col("dimensions")["route"].alias("route"), F.size("dimensions").alias("n_dims"), F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "value",
        F.regexp_extract("identity", ":([0-9]{9})$", 1).cast("long").alias("ordinal"),
    )


@query("""SELECT ts AS "timestamp", CASE WHEN event_id % 10 <> 0 THEN event_type END AS severity, CASE WHEN event_id % 10 <> 0 THEN event_type ELSE 'lvl' END AS signal_kind,
  CAST(CASE WHEN event_id % 5 IN (1, 2, 3) THEN event_id % 5 ELSE 1 END AS DOUBLE) AS value, CAST(CASE WHEN event_id % 10 <> 0 THEN 3 ELSE 2 END AS INTEGER) AS n_dims FROM events""")
def log_stream_records(spark, d):
    """Range query answers: empty labels and noise go, unreadable duplicate counts are 1, nanoseconds are cut to microseconds."""
    severity = F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(F.col("event_type"))
    dedup = F.when(F.col("event_id") % 5 == 4, F.lit("x")).otherwise((F.col("event_id") % 5).cast("string"))
    e = events(spark, d).select(severity.alias("severity"), dedup.alias("dedup"), X.bucket_start(F.col("ts"), HOUR).alias("hour"), F.array(_nanos(), F.lit("line")).alias("entry"))
    s = e.groupBy("severity", "dedup", "hour").agg(F.collect_list("entry").alias("entries"))
    labels = {"service_name": F.lit("shop"), "severity_text": F.col("severity"), "detected_level": F.lit("lvl"), "trace_id": F.lit("abc"), "dedup_count": F.col("dedup")}
    stream = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), v)])
    result = F.array(F.struct(stream.alias("stream"), F.col("entries").alias("values")))
    answers = _responses(s, F.struct(F.struct(F.lit("streams").alias("resultType"), result.alias("result")).alias("data")))
    r = shapes.log_records(shapes.parsed(answers, shapes.STREAMS))
    return r.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.col("dimensions")["severity_text"].alias("severity"), "signal_kind", "value", F.size("dimensions").alias("n_dims"))


@query("""SELECT 't' || event_id AS identity, ts AS "timestamp", event_type AS root_name, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_id % 7 = 0 THEN 0 ELSE value END AS value FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0""")
def trace_search_records(spark, d):
    """Search answers, all and errored: traces without id or start go, a missing duration is 0."""
    e = F.col("event_id")
    trace = F.struct(
        F.when(e % 13 != 0, F.concat(F.lit("t"), e.cast("string"))).alias("traceID"), F.lit("shop").alias("rootServiceName"), F.col("event_type").alias("rootTraceName"),
        F.when(e % 17 != 0, _nanos()).alias("startTimeUnixNano"), F.when(e % 7 != 0, F.col("value")).alias("durationMs"),
    )
    rows = events(spark, d).select("event_type", X.bucket_start(F.col("ts"), HOUR).alias("hour"), trace.alias("trace"))

    def found(df):
        pages = df.groupBy("hour").agg(F.collect_list("trace").alias("traces"))
        return shapes.parsed(_responses(pages, F.struct("traces")), shapes.SEARCH)

    r = shapes.trace_records(found(rows), found(rows.where("event_type = 'error'")))
    dims = F.col("dimensions")
    return r.select("identity", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), dims["root_name"].alias("root_name"), dims["status"].alias("status"), "value")


@query(f"""WITH r AS ({_sql_metrics("day")}), u AS (
  SELECT bucket_start, metric, shard, 'delta' AS aggregate, delta_v AS value FROM r WHERE is_counter = 1 UNION ALL SELECT bucket_start, metric, shard, 'count', n::DOUBLE FROM r
  UNION ALL SELECT bucket_start, metric, shard, 'avg', sum_v / n FROM r WHERE is_counter = 0 UNION ALL SELECT bucket_start, metric, shard, 'min', min_v FROM r WHERE is_counter = 0
  UNION ALL SELECT bucket_start, metric, shard, 'max', max_v FROM r WHERE is_counter = 0)
SELECT 'rollup_' || metric || '_' || aggregate AS name, 'granularity="1d",rollup_schema="1",route="/' || shard || '",service_name="shop",tier="cold"' AS labels, round(value, 6) AS value, epoch_ms(bucket_start) AS stamp
FROM u WHERE value IS NOT NULL""")
def vm_projection_lines(spark, d):
    """Exposition lines, taken apart again."""
    lines = projections.prometheus_lines(A.rollup(raw_records(spark, d, "metrics"), SPECS["metrics"], DAILY))
    part = lambda i: F.regexp_extract("value", r"^([^{]+)\{(.*)\} (\S+) ([0-9]+)$", i)
    return lines.select(part(1).alias("name"), part(2).alias("labels"), F.round(part(3).cast("double"), 6).alias("value"), part(4).cast("long").alias("stamp"))


@query(f"""WITH {LOGS}, r AS (SELECT date_trunc('hour', ts) AS b, severity_text AS severity, count(*) AS n, {sql_sum("value")} AS s, min(value) AS lo, max(value) AS hi FROM l GROUP BY 1, 2)
SELECT severity, CAST(6 AS INTEGER) AS n_labels, CAST(epoch_ms(b) AS VARCHAR) || '000000' AS ts_ns, 'bucket_start,dedup_factor,entries,events,is_counter,max,min' AS keys,
  strftime(b, '%Y-%m-%dT%H:%M:%SZ') AS bucket_start, s AS events, n::DOUBLE AS entries, round(s / n, 9) AS dedup_factor, lo AS min_v, hi AS max_v FROM r""")
def loki_projection_json(spark, d):
    """Log lines, parsed again; their keys are in order."""
    lines = projections.log_lines(A.rollup(raw_records(spark, d, "logs"), SPECS["logs"], HOURLY))
    number = lambda k: F.get_json_object("line", f"$.{k}").cast("double")
    return lines.select(
        F.col("stream")["severity_text"].alias("severity"), F.size("stream").alias("n_labels"), "ts_ns", F.array_join(F.json_object_keys("line"), ",").alias("keys"),
        F.get_json_object("line", "$.bucket_start").alias("bucket_start"), number("events").alias("events"), number("entries").alias("entries"), F.round(number("dedup_factor"), 9).alias("dedup_factor"),
        number("min").alias("min_v"), number("max").alias("max_v"),
    )


@query(f"""WITH r AS ({_sql_metrics("day")})
SELECT bucket_start, strftime(bucket_start, '%Y-%m-%d') AS date, epoch_ms(bucket_start) // 1000 AS bucket, metric, '/' || shard AS route, n, sum_v, min_v, max_v, first_v, last_v, delta_v, is_counter FROM r""")
def cold_tier_rows(spark, d):
    """Rollup rows written to an archive, written once more, and read back."""
    root, rows = _scratch(spark), A.rollup(raw_records(spark, d, "metrics"), SPECS["metrics"], DAILY)
    parquet.write(rows, root)
    parquet.write(rows.where("metric = 'click_total'").unionByName(rows.where("metric <> 'click_total'")), root)
    r = parquet.read(spark, root)
    return r.select(
        F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), "date", "bucket", "metric", F.col("dimensions")["route"].alias("route"), F.col("count").alias("n"), F.round("sum", 6).alias("sum_v"),
        F.col("min").alias("min_v"), F.col("max").alias("max_v"), F.col("first").alias("first_v"), F.col("last").alias("last_v"), F.round("delta", 4).alias("delta_v"), F.col("extras")["is_counter"].alias("is_counter"),
    )


@query(f"""WITH {METRICS}, r AS (SELECT date_trunc('day', ts) AS b, metric, shard, count(*) AS n FROM m GROUP BY 1, 2, 3),
x AS (SELECT 'metrics' AS signal, count(DISTINCT b) + 2 AS files, CAST(2 AS BIGINT) AS empty_files, count(*) AS rows, CAST(sum(n) AS BIGINT) AS raw FROM r)
SELECT signal, files, empty_files, rows, raw, round(raw::DOUBLE / rows, 6) AS reduction FROM x UNION ALL SELECT 'total', files, empty_files, rows, raw, round(raw::DOUBLE / rows, 6) FROM x""")
def archive_ratio(spark, d):
    """What an archive with two empty buckets holds, by its files."""
    from datetime import UTC, datetime

    root = _scratch(spark)
    parquet.write(A.rollup(raw_records(spark, d, "metrics"), SPECS["metrics"], DAILY), root)
    parquet.write_empty(spark, root, "metrics", DAILY, [DAILY.bucket(datetime(2023, 6, day, tzinfo=UTC)) for day in (1, 2)])
    return ratio(spark, root, "1d").select("signal", "files", "empty_files", "rows", "raw", F.round("reduction", 6).alias("reduction"))


@query(f"""WITH {TRACES} SELECT date_trunc('day', ts) AS bucket_start, root_name, status, {", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in POINTS)} FROM t GROUP BY 1, 2, 3""")
def trace_percentile_extras(spark, d):
    r = A.rollup(raw_records(spark, d, "traces"), SPECS["traces"], DAILY)
    dims, extras = F.col("dimensions"), F.col("extras")
    return r.select(F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), dims["root_name"].alias("root_name"), dims["status"].alias("status"), *[F.round(extras[f"p{p}"], 6).alias(f"p{p}") for p in POINTS])


@query("SELECT event_id, ts AS at FROM events")
def nanosecond_times(spark, d):
    return events(spark, d).select("event_id", X.from_nanos(_nanos()).cast("timestamp_ntz").alias("at"))


@query("""SELECT event_id, replace(replace(replace(x, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') AS label FROM
  (SELECT event_id, event_type || CASE event_id % 4 WHEN 0 THEN '\\' WHEN 1 THEN '"' WHEN 2 THEN chr(10) ELSE '' END || '\\n"' AS x FROM events)""")
def label_escapes(spark, d):
    n = F.col("event_id") % 4
    tail = F.when(n == 0, F.lit("\\")).when(n == 1, F.lit('"')).when(n == 2, F.lit("\n")).otherwise(F.lit(""))
    return events(spark, d).select("event_id", X.escaped_label(F.concat("event_type", tail, F.lit('\\n"'))).alias("label"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a,route' ELSE 'route' END AS kept FROM events""")
def dropped_labels(spark, d):
    """Dimensions without dropped, empty and null labels, in order."""
    e = F.col("event_id")
    given = F.create_map(
        F.lit("route"), F.lit("/"), F.lit("job"), F.lit("j"), F.lit("instance"), F.lit("i"), F.lit("__name__"), F.lit("n"),
        F.lit("a"), F.when(e % 3 == 0, F.lit("1")).when(e % 3 == 1, F.lit("")),
    )
    return events(spark, d).select("event_id", F.array_join(F.map_keys(X.canonical(X.without(given, shapes.METRIC_NOISE))), ",").alias("kept"))
