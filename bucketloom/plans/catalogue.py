"""The registered queries, over signals emulated from the driver's ``events`` table, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bucketloom import functions as X
from bucketloom.model import DAY, SPECS, Granularity
from bucketloom.operators import relational as R
from bucketloom.operators import rollup as A
from bucketloom.sinks import projections

HOUR = 3600
NOW = datetime(2024, 1, 15, 12, 5)
LO, HI = datetime(2024, 1, 10, 6), datetime(2024, 1, 10, 18)
POINTS = (50, 90, 95, 99)


def events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def metric_samples(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    metric = F.concat(t, F.when(t.isin("click", "view", "purchase"), F.lit("_total")).otherwise(F.lit("_value")))
    return events(spark, d).select("event_id", "ts", "user_id", "value", metric.alias("metric"), (F.col("user_id") % 4).cast("string").alias("shard"))


def log_entries(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    severity = F.when(e % 10 == 0, F.lit(" ")).when(e % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    n = X.positive_int(F.get_json_object("props", "$.k")).cast("double")
    return events(spark, d).select("event_id", "ts", severity.alias("raw_severity"), X.folded_severity(severity).alias("severity_text"), n.alias("value"))


def traces(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).select("event_id", "ts", "value", F.col("event_type").alias("root_name"))
    return R.flagged(e, e.where("root_name = 'error'"), "event_id")


def raw_records(spark: SparkSession, d: str, signal: str) -> DataFrame:
    """The emulated signal in the shape of model.RAW."""
    if signal == "metrics":
        df, kind = metric_samples(spark, d), F.col("metric")
        dims = {"service_name": F.lit("shop"), "route": F.concat(F.lit("/"), F.col("shard"))}
    elif signal == "logs":
        df, kind = log_entries(spark, d), F.col("raw_severity")
        dims = {"service_name": F.lit("shop"), "severity_text": F.col("raw_severity")}
    else:
        df, kind = traces(spark, d), F.lit("trace")
        dims = {"root_service_name": F.lit("shop"), "root_name": F.col("root_name"), "status": F.col("status")}
    pairs = [x for k, v in dims.items() for x in (F.lit(k), v)]
    return df.select(
        F.lit(signal).alias("signal"), F.col("ts").cast("timestamp").alias("timestamp"), F.create_map(*pairs).alias("dimensions"),
        F.col("value").cast("double"), F.col("event_id").cast("string").alias("identity"), kind.alias("signal_kind"),
    )


# SQL twins of the emulated signals
METRICS = """m AS (SELECT event_id, ts, user_id, value, event_type || CASE WHEN event_type IN ('click', 'view', 'purchase') THEN '_total' ELSE '_value' END AS metric,
  CAST(user_id % 4 AS VARCHAR) AS shard FROM events)"""
LOGS = """l0 AS (SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN ' ' WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS raw_severity,
  try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
l AS (SELECT event_id, ts, raw_severity, CASE WHEN lower(trim(raw_severity)) IN ('', 'unknown', 'unspecified', 'none') THEN 'unknown' ELSE lower(trim(raw_severity)) END AS severity_text,
  CAST(CASE WHEN k > 0 THEN k ELSE 1 END AS DOUBLE) AS value FROM l0)"""
TRACES = "t AS (SELECT event_id, ts, value, event_type AS root_name, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status FROM events)"


def sql_sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


def _sql_metrics(unit: str) -> str:
    return f"""WITH {METRICS}, b AS (SELECT date_trunc('{unit}', ts) AS bucket_start, * FROM m),
s AS (SELECT *, lag(value) OVER (PARTITION BY bucket_start, metric, shard ORDER BY ts, event_id) AS prev FROM b)
SELECT bucket_start, metric, shard, count(*) AS n, round({sql_sum("value")}, 6) AS sum_v, min(value) AS min_v, max(value) AS max_v,
  arg_min(value, row(ts, event_id)) AS first_v, arg_max(value, row(ts, event_id)) AS last_v,
  round({sql_sum("CASE WHEN right(metric, 6) <> '_total' OR prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END")}, 4) AS delta_v,
  round({sql_sum("value")} / count(*), 6) AS avg_v, CASE WHEN right(metric, 6) = '_total' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_counter
FROM s GROUP BY ALL"""


def _metrics(width: int):
    def q(spark: SparkSession, d: str) -> DataFrame:
        m = metric_samples(spark, d).withColumn("bucket_start", X.bucket_start(F.col("ts"), width))
        counter = X.is_cumulative(F.col("metric"))
        out = A.aggregate(m, ["bucket_start", "metric", "shard"], ["ts", "event_id"], counter=counter)
        return out.select(
            "bucket_start", "metric", "shard", F.col("count").alias("n"), F.round("sum", 6).alias("sum_v"), F.col("min").alias("min_v"), F.col("max").alias("max_v"),
            F.col("first").alias("first_v"), F.col("last").alias("last_v"), F.round("delta", 4).alias("delta_v"), F.round("avg", 6).alias("avg_v"),
            F.when(counter, 1.0).otherwise(0.0).alias("is_counter"),
        )

    return q


def _logs(width: int):
    def q(spark: SparkSession, d: str) -> DataFrame:
        df = log_entries(spark, d).withColumn("bucket_start", X.bucket_start(F.col("ts"), width))
        out = A.aggregate(df, ["bucket_start", "severity_text"], ["ts", "event_id"])
        return out.select("bucket_start", "severity_text", F.col("count").alias("entries"), F.col("sum").alias("events"), F.col("min").alias("min_v"), F.col("max").alias("max_v"),
                          F.col("first").alias("first_v"), F.col("last").alias("last_v"), F.round("avg", 6).alias("dedup_factor"))

    return q


def _sql_logs(unit: str) -> str:
    return f"""WITH {LOGS} SELECT date_trunc('{unit}', ts) AS bucket_start, severity_text, count(*) AS entries, {sql_sum("value")} AS events, min(value) AS min_v, max(value) AS max_v,
  arg_min(value, row(ts, event_id)) AS first_v, arg_max(value, row(ts, event_id)) AS last_v, round({sql_sum("value")} / count(*), 6) AS dedup_factor FROM l GROUP BY 1, 2"""


def _traces(width: int):
    def q(spark: SparkSession, d: str) -> DataFrame:
        df = traces(spark, d).withColumn("bucket_start", X.bucket_start(F.col("ts"), width))
        out = A.aggregate(df, ["bucket_start", "root_name", "status"], ["ts", "event_id"], percentiles=POINTS)
        return out.select("bucket_start", "root_name", "status", F.col("count").alias("n"), F.round("sum", 6).alias("sum_v"), F.col("min").alias("min_v"), F.col("max").alias("max_v"),
                          F.col("first").alias("first_v"), F.col("last").alias("last_v"), *[F.round(f"p{p}", 6).alias(f"p{p}") for p in POINTS])

    return q


def _sql_traces(unit: str) -> str:
    points = ", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in POINTS)
    return f"""WITH {TRACES} SELECT date_trunc('{unit}', ts) AS bucket_start, root_name, status, count(*) AS n, round({sql_sum("value")}, 6) AS sum_v, min(value) AS min_v, max(value) AS max_v,
  arg_min(value, row(ts, event_id)) AS first_v, arg_max(value, row(ts, event_id)) AS last_v, {points} FROM t GROUP BY 1, 2, 3"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


for _name, _make, _sql in (("metrics", _metrics, _sql_metrics), ("logs", _logs, _sql_logs), ("traces", _traces, _sql_traces)):
    for _g, _w, _u in (("1h", HOUR, "hour"), ("1d", DAY, "day")):
        QUERIES[f"{_name}_rollup_{_g}"], SQL[f"{_name}_rollup_{_g}"] = _make(_w), _sql(_u)


@query(f"""WITH {METRICS}, s AS (SELECT *, date_trunc('hour', ts) AS bucket_start, lag(value) OVER (PARTITION BY date_trunc('hour', ts), metric ORDER BY ts, event_id) AS prev FROM m WHERE right(metric, 6) = '_total')
SELECT bucket_start, metric, round({sql_sum("CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END")}, 4) AS delta_v, count(*) AS n FROM s GROUP BY 1, 2""")
def counter_delta_1h(spark, d):
    m = metric_samples(spark, d).where(X.is_cumulative(F.col("metric"))).withColumn("bucket_start", X.bucket_start(F.col("ts"), HOUR))
    m = A.with_increase(m, ["bucket_start", "metric"], ["ts", "event_id"])
    return m.groupBy("bucket_start", "metric").agg(F.round(A.exact_sum(F.col("increase")), 4).alias("delta_v"), F.count("*").alias("n"))


@query(f"""WITH {METRICS} SELECT date_trunc('hour', ts) AS bucket_start, metric, count(*) AS n, round({sql_sum("value")}, 6) AS sum_v, min(value) AS min_v, max(value) AS max_v, round({sql_sum("value")} / count(*), 6) AS avg_v
FROM m WHERE right(metric, 6) = '_value' GROUP BY 1, 2""")
def gauge_stats_1h(spark, d):
    m = metric_samples(spark, d).where(~X.is_cumulative(F.col("metric"))).withColumn("bucket_start", X.bucket_start(F.col("ts"), HOUR))
    s = A.exact_sum(F.col("value"))
    return m.groupBy("bucket_start", "metric").agg(F.count("*").alias("n"), F.round(s, 6).alias("sum_v"), F.min("value").alias("min_v"), F.max("value").alias("max_v"), F.round(s / F.count("*"), 6).alias("avg_v"))


@query(f"""WITH {METRICS}, s AS (SELECT *, date_trunc('hour', ts) AS bucket_start, lag(value) OVER (PARTITION BY date_trunc('hour', ts), metric ORDER BY ts, event_id) AS prev FROM m)
SELECT bucket_start, metric, CAST(sum(CASE WHEN value < prev THEN 1 ELSE 0 END) AS BIGINT) AS resets FROM s GROUP BY 1, 2""")
def reset_count_1h(spark, d):
    m = metric_samples(spark, d).withColumn("bucket_start", X.bucket_start(F.col("ts"), HOUR))
    prev = F.lag("value").over(Window.partitionBy("bucket_start", "metric").orderBy("ts", "event_id"))
    m = m.withColumn("reset", F.when(F.col("value") < prev, 1).otherwise(0))
    return m.groupBy("bucket_start", "metric").agg(F.sum("reset").cast("long").alias("resets"))


@query("""SELECT date_trunc('hour', ts) AS bucket_start, event_type, arg_min(value, row(ts, event_id)) AS first_v, arg_max(value, row(ts, event_id)) AS last_v FROM events GROUP BY 1, 2""")
def first_last_1h(spark, d):
    at = F.struct("ts", "event_id")
    e = events(spark, d).withColumn("bucket_start", X.bucket_start(F.col("ts"), HOUR))
    return e.groupBy("bucket_start", "event_type").agg(F.min_by("value", at).alias("first_v"), F.max_by("value", at).alias("last_v"))


@query(f"""WITH {TRACES} SELECT status, count(*) AS n, {", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in POINTS)} FROM t GROUP BY 1""")
def percentiles_by_status(spark, d):
    out = A.aggregate(traces(spark, d), ["status"], ["ts", "event_id"], percentiles=POINTS)
    return out.select("status", F.col("count").alias("n"), *[F.round(f"p{p}", 6).alias(f"p{p}") for p in POINTS])


@query("SELECT event_id, ts, value FROM events WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'error')")
def error_traces_semi(spark, d):
    e = events(spark, d)
    return R.members(e.select("event_id", "ts", "value"), e.where("event_type = 'error'"), "event_id")


@query("SELECT event_id, ts, value FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')")
def ok_traces_anti(spark, d):
    e = events(spark, d)
    return R.others(e.select("event_id", "ts", "value"), e.where("event_type = 'error'"), "event_id")


@query(f"WITH {TRACES} SELECT event_id, root_name, status FROM t")
def trace_status_flag(spark, d):
    return traces(spark, d).select("event_id", "root_name", "status")


@query(f"""WITH {TRACES}, r AS (SELECT date_trunc('hour', ts) AS bucket_start, status, count(*) AS n FROM t GROUP BY 1, 2)
SELECT bucket_start, CAST(sum(n) AS BIGINT) AS n, round(sum(CASE WHEN status = 'error' THEN n ELSE 0 END)::DOUBLE / sum(n), 9) AS error_rate FROM r GROUP BY 1""")
def error_rate_1h(spark, d):
    t = traces(spark, d).groupBy(X.bucket_start(F.col("ts"), HOUR).alias("bucket_start"), "status").count()
    failed = F.sum(F.when(F.col("status") == "error", F.col("count")).otherwise(0))
    return t.groupBy("bucket_start").agg(F.sum("count").alias("n"), F.round(failed / F.sum("count"), 9).alias("error_rate"))


@query(f"WITH {LOGS} SELECT severity_text, count(*) AS entries, count(DISTINCT raw_severity) AS spellings FROM l GROUP BY 1")
def severity_fold_counts(spark, d):
    return log_entries(spark, d).groupBy("severity_text").agg(F.count("*").alias("entries"), F.count_distinct("raw_severity").alias("spellings"))


@query(f"WITH {LOGS} SELECT severity_text, round({sql_sum('value')} / count(*), 6) AS dedup_factor FROM l GROUP BY 1")
def dedup_factor_by_severity(spark, d):
    return log_entries(spark, d).groupBy("severity_text").agg(F.round(A.exact_sum(F.col("value")) / F.count("*"), 6).alias("dedup_factor"))


@query(f"""SELECT date_trunc('hour', ts) AS bucket_start, count(*) AS n FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR + INTERVAL 10 MINUTE <= TIMESTAMP '{NOW}' GROUP BY 1""")
def sealed_buckets_only(spark, d):
    grace = 600
    until = Granularity("1h", HOUR).watermark(NOW.replace(tzinfo=UTC), SPECS["logs"].grace).replace(tzinfo=None)
    e = events(spark, d).where(F.col("ts") < F.lit(until))  # reaches the scan; the seal rule decides
    e = e.withColumn("bucket_start", X.bucket_start(F.col("ts"), HOUR))
    end = F.col("bucket_start") + F.make_dt_interval(secs=F.lit(HOUR))
    return e.where(X.is_sealed(end, F.lit(NOW), grace)).groupBy("bucket_start").agg(F.count("*").alias("n"))


@query(f"""SELECT signal, granularity, CASE WHEN granularity = '1h' THEN date_trunc('hour', TIMESTAMP '{NOW}' - to_seconds(grace)) ELSE date_trunc('day', TIMESTAMP '{NOW}' - to_seconds(grace)) END AS watermark,
  CASE WHEN granularity = '1h' THEN date_trunc('hour', TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) ELSE date_trunc('day', TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) END AS cold_start
FROM (VALUES ('metrics', 120), ('logs', 600), ('traces', 1200)) s(signal, grace), (VALUES ('1h'), ('1d')) g(granularity)""")
def watermark_per_signal(spark, d):
    rows = [(s.name, g, int(s.grace.total_seconds()), w) for s in SPECS.values() for g, w in (("1h", HOUR), ("1d", DAY))]
    df = spark.createDataFrame(rows, "signal string, granularity string, grace int, width int")
    now = F.lit(NOW)
    hourly, daily = df.where(f"width = {HOUR}"), df.where(f"width = {DAY}")
    out = [part.select("signal", "granularity", X.watermark(now, F.col("grace"), w).alias("watermark"), X.watermark(now, DAY, w).alias("cold_start")) for part, w in ((hourly, HOUR), (daily, DAY))]
    return out[0].unionByName(out[1])


@query("""WITH s AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-10 23:59:00', INTERVAL 1 MINUTE)) AS bucket_start),
e AS (SELECT date_trunc('minute', ts) AS bucket_start, count(*) AS n FROM events GROUP BY 1)
SELECT bucket_start, coalesce(n, 0) AS n, n IS NULL AS is_empty FROM s LEFT JOIN e USING (bucket_start)""")
def empty_bucket_spine(spark, d):
    lo, hi = datetime(2024, 1, 10), datetime(2024, 1, 11)
    e = events(spark, d).where(X.in_range(F.col("ts"), lo, hi)).groupBy(X.bucket_start(F.col("ts"), 60).alias("bucket_start")).agg(F.count("*").alias("n"))
    return R.bucket_spine(e, lo, hi, 60).select("bucket_start", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.col("n").isNull().alias("is_empty"))


@query(f"SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}'")
def half_open_slice(spark, d):
    return events(spark, d).where(X.in_range(F.col("ts"), LO, HI)).select("event_id", "ts", "event_type", "value")


@query(f"""SELECT CAST(floor(epoch(ts - TIMESTAMP '{LO}') / 4320) AS INTEGER) AS slice, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}' GROUP BY 1""")
def adjacent_slices_tile(spark, d):
    step = (HI - LO) / 10
    parts = [events(spark, d).where(X.in_range(F.col("ts"), LO + i * step, LO + (i + 1) * step)).select(F.lit(i).alias("slice")) for i in range(10)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("slice").agg(F.count("*").alias("n"))


@query("""SELECT event_id, event_type, date_trunc('hour', ts) AS ts_h, CAST(row_number() OVER w AS BIGINT) - 1 AS ordinal, count(*) OVER (PARTITION BY event_type, date_trunc('hour', ts)) AS same_instant
FROM events WINDOW w AS (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY value, event_id)""")
def same_instant_ordinals(spark, d):
    e = events(spark, d).select("event_id", "event_type", "value", X.bucket_start(F.col("ts"), HOUR).alias("ts_h"))
    out = R.ordinals(e, ["event_type"], "ts_h", ["value", "event_id"])
    return out.select("event_id", "event_type", "ts_h", F.col("ordinal").cast("long").alias("ordinal"), "same_instant")


@query("SELECT count(*) AS collisions, coalesce(CAST(sum(n) AS BIGINT), 0) AS records FROM (SELECT event_type, ts, value, count(*) AS n FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1)")
def identity_collisions(spark, d):
    e = events(spark, d).withColumn("identity", X.identity(F.col("event_type"), F.col("ts"), F.col("value")))
    found = R.collisions(e, ["identity"])
    return found.agg(F.count("*").alias("collisions"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("records"))


@query("SELECT 0::BIGINT AS duplicates, (SELECT count(DISTINCT row(date_trunc('hour', ts), event_type, user_id % 4)) FROM events) AS rows")
def duplicate_rollup_keys(spark, d):
    rolled = _metrics(HOUR)(spark, d)
    keys = ["bucket_start", "metric", "shard"]
    return R.collisions(rolled, keys).agg(F.count("*").alias("duplicates")).crossJoin(rolled.agg(F.count("*").alias("rows")))


@query("""WITH r AS (SELECT unnest(CASE WHEN event_id % 3 = 0 THEN ['route', 'shard', 'extra'] ELSE ['route', 'shard'] END) AS key FROM events), s AS (SELECT key, count(*) AS n FROM r GROUP BY 1)
SELECT 'missing' AS kind, k AS key, 0::BIGINT AS n FROM (VALUES ('service_name'), ('route'), ('method')) c(k) WHERE k NOT IN (SELECT key FROM s)
UNION ALL SELECT 'unexpected', key, n FROM s WHERE key NOT IN ('service_name', 'route', 'method')""")
def dimension_drift(spark, d):
    return R.drift(_drifting(spark, d), ["service_name", "route", "method"])


@query("""WITH r AS (SELECT unnest(CASE WHEN event_id % 3 = 0 THEN ['route', 'shard', 'extra'] ELSE ['route', 'shard'] END) AS key FROM events), s AS (SELECT key, count(*) AS n FROM r GROUP BY 1)
SELECT key, n FROM s WHERE key NOT IN ('service_name', 'method') ORDER BY n DESC, key LIMIT 2""")
def unexpected_dims_topk(spark, d):
    return R.top_unexpected(R.drift(_drifting(spark, d), ["service_name", "method"]), 2).select("key", "n")


def _drifting(spark, d):
    e = metric_samples(spark, d)
    extra = F.when(F.col("event_id") % 3 == 0, F.lit("x")).otherwise(F.lit(""))
    return e.select(F.create_map(F.lit("route"), F.lit("/r"), F.lit("shard"), F.col("shard"), F.lit("extra"), extra, F.lit("method"), F.lit(None).cast("string")).alias("dimensions"))


@query(f"WITH {METRICS} SELECT metric, CASE WHEN regexp_matches(metric, '(_total|_count|_sum|_bucket)$') THEN 'counter' ELSE 'gauge' END AS metric_type, count(*) AS n FROM m GROUP BY 1, 2")
def metric_type_inference(spark, d):
    kind = F.when(X.is_cumulative(F.col("metric")), F.lit("counter")).otherwise(F.lit("gauge"))
    return metric_samples(spark, d).groupBy("metric", kind.alias("metric_type")).agg(F.count("*").alias("n"))


@query(f"""WITH r AS ({_sql_metrics("day")}), u AS (
  SELECT bucket_start, metric, shard, 'delta' AS aggregate, delta_v AS value FROM r WHERE is_counter = 1 UNION ALL SELECT bucket_start, metric, shard, 'count', n::DOUBLE FROM r
  UNION ALL SELECT bucket_start, metric, shard, 'avg', sum_v / n FROM r WHERE is_counter = 0 UNION ALL SELECT bucket_start, metric, shard, 'min', min_v FROM r WHERE is_counter = 0
  UNION ALL SELECT bucket_start, metric, shard, 'max', max_v FROM r WHERE is_counter = 0)
SELECT bucket_start, 'rollup_' || metric || '_' || aggregate AS name, shard, round(value, 9) AS value FROM u WHERE value IS NOT NULL""")
def vm_projection_long(spark, d):
    r = A.rollup(raw_records(spark, d, "metrics"), SPECS["metrics"], Granularity("1d", DAY))
    long = projections.long_form(r)
    return long.select(F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), "name", F.substring(F.col("dimensions")["route"], 2, 10).alias("shard"), F.round("value", 9).alias("value"))




@query("""SELECT count(*) AS n FROM events WHERE NOT starts_with(CASE WHEN event_id % 5 = 0 THEN 'rollup_' || event_type ELSE event_type END, 'rollup_')
  AND coalesce(CASE WHEN event_id % 7 = 0 THEN 'cold' WHEN event_id % 2 = 0 THEN 'hot' END, '') <> 'cold'""")
def cold_exclusion(spark, d):
    e = events(spark, d)
    name = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("rollup_"), F.col("event_type"))).otherwise(F.col("event_type"))
    tier = F.when(F.col("event_id") % 7 == 0, F.lit("cold")).when(F.col("event_id") % 2 == 0, F.lit("hot"))
    e = e.select(name.alias("name"), F.create_map(F.lit("tier"), tier).alias("dims"))
    return R.selected(e, F.col("name"), F.col("dims"), projections.PREFIX).agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT event_type AS signal, date_trunc('hour', ts) AS b, user_id % 4 AS shard, count(*) AS n FROM events GROUP BY 1, 2, 3)
SELECT coalesce(signal, 'total') AS signal, CAST(sum(n) AS BIGINT) AS raw, count(*) AS rows, round(sum(n)::DOUBLE / count(*), 6) AS reduction FROM r GROUP BY ROLLUP (signal)""")
def tiering_ratio_rollup(spark, d):
    e = events(spark, d).withColumn("b", X.bucket_start(F.col("ts"), HOUR))
    r = e.groupBy(F.col("event_type").alias("signal"), "b", (F.col("user_id") % 4).alias("shard")).agg(F.count("*").alias("n"))
    out = r.rollup("signal").agg(F.sum("n").alias("raw"), F.count("*").alias("rows"))
    return out.select(F.coalesce("signal", F.lit("total")).alias("signal"), "raw", "rows", F.round(F.col("raw") / F.col("rows"), 6).alias("reduction"))


@query(f"""WITH {METRICS}, {LOGS}, {TRACES}
SELECT 'metrics' AS signal, date_trunc('hour', ts) AS bucket_start, metric, count(*) AS n, round({sql_sum("value")}, 6) AS sum_v FROM m GROUP BY 2, 3
UNION ALL SELECT 'logs', date_trunc('hour', ts), 'log_events', count(*), round({sql_sum("value")}, 6) FROM l GROUP BY 2
UNION ALL SELECT 'traces', date_trunc('hour', ts), 'trace_duration_ms', count(*), round({sql_sum("value")}, 6) FROM t GROUP BY 2""")
def rollup_union_all_signals(spark, d):
    out = None
    for s in ("metrics", "logs", "traces"):
        r = A.rollup(raw_records(spark, d, s), SPECS[s], Granularity("1h", HOUR))
        out = r if out is None else out.unionByName(r)
    out = out.groupBy("signal", F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), "metric")
    return out.agg(F.sum("count").alias("n"), F.round(A.exact_sum(F.col("sum")), 6).alias("sum_v"))


@query(f"""SELECT date_trunc('day', ts) AS bucket_start, event_type, count(*) AS n, round({sql_sum("value")}, 6) AS sum_v, min(value) AS min_v, max(value) AS max_v FROM events GROUP BY 1, 2""")
def hourly_to_daily_reagg(spark, d):
    e = events(spark, d).groupBy(X.bucket_start(F.col("ts"), HOUR).alias("h"), "event_type")
    h = e.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(28,6)")).alias("s"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    day = h.groupBy(X.bucket_start(F.col("h"), DAY).alias("bucket_start"), "event_type")
    return day.agg(F.sum("n").alias("n"), F.round(F.sum("s").cast("double"), 6).alias("sum_v"), F.min("lo").alias("min_v"), F.max("hi").alias("max_v"))


@query("""WITH b AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events), x AS (SELECT event_type, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS h FROM (SELECT DISTINCT event_type FROM events))
SELECT event_type, coalesce(min(x.h) FILTER (b.h IS NULL), TIMESTAMP '2024-01-31') AS next_start FROM x LEFT JOIN b USING (event_type, h) GROUP BY 1""")
def frontier_gaps(spark, d):
    e = events(spark, d).select("event_type", X.bucket_start(F.col("ts"), HOUR).alias("h")).distinct()
    hours = F.explode(F.sequence(F.lit(datetime(2024, 1, 1)), F.lit(datetime(2024, 1, 30, 23)), F.expr("interval 1 hour")))
    expected = events(spark, d).select("event_type").distinct().select("event_type", hours.alias("h"))
    return R.gaps(expected, e, ["event_type"], "h", HOUR)


_DURATIONS = ["3d", "72h", "2160h", "30m", "1w", "1.5h", "90s", "2Y", "", "forever", "3", "d", "3 days"]


@query(f"""WITH v AS (SELECT unnest({_DURATIONS}) AS given), p AS (SELECT given, regexp_extract(given, '^\\s*([0-9]+(?:\\.[0-9]+)?)\\s*([smhdwySMHDWY])\\s*$', 1) AS q, lower(regexp_extract(given, '^\\s*([0-9]+(?:\\.[0-9]+)?)\\s*([smhdwySMHDWY])\\s*$', 2)) AS u FROM v),
s AS (SELECT given, try_cast(q AS DOUBLE) * CASE u WHEN 's' THEN 1 WHEN 'm' THEN 60 WHEN 'h' THEN 3600 WHEN 'd' THEN 86400 WHEN 'w' THEN 604800 WHEN 'y' THEN 31536000 END AS seconds FROM p)
SELECT given, seconds, CASE WHEN seconds::BIGINT % 86400 = 0 THEN (seconds::BIGINT // 86400) || 'd' WHEN seconds::BIGINT % 3600 = 0 THEN (seconds::BIGINT // 3600) || 'h' ELSE (seconds::BIGINT // 60) || 'm' END AS shown FROM s""")
def retention_durations(spark, d):
    df = spark.createDataFrame([(x,) for x in _DURATIONS], "given string").withColumn("seconds", X.duration_seconds(F.col("given")))
    return df.withColumn("shown", F.when(F.col("seconds").isNotNull(), X.humanised(F.col("seconds"))))


@query("""WITH v(backend, hot) AS (VALUES ('metrics', 259200), ('logs', 12000), ('traces', 12060), ('lost', NULL))
SELECT backend, CAST(hot AS BIGINT) AS hot, coalesce(hot > 1200 + 3600 + 7200, false) AS safe, coalesce(hot > 1200 + 3600 + 7200 + 3600, false) AS safe_with_width FROM v""")
def safety_margin_check(spark, d):
    df = spark.createDataFrame([("metrics", 259_200), ("logs", 12_000), ("traces", 12_060), ("lost", None)], "backend string, hot long")
    args = (F.col("hot"), F.lit(1200), F.lit(HOUR), F.lit(7200))
    return df.withColumn("safe", X.is_safe(*args)).withColumn("safe_with_width", X.is_safe(*args, HOUR))


@query(f"""SELECT date_trunc('day', l_shipdate) AS bucket_start, l_returnflag, l_linestatus, count(*) AS n, round({sql_sum("l_quantity")}, 4) AS sum_qty, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem GROUP BY 1, 2, 3""")
def lineitem_daily_rollup(spark, d):
    df = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(X.bucket_start(F.col("l_shipdate"), DAY).alias("bucket_start"), "l_returnflag", "l_linestatus")
    return df.agg(F.count("*").alias("n"), F.round(A.exact_sum(F.col("l_quantity")), 4).alias("sum_qty"), F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"))
