"""Column builders: every one stays inside Catalyst's expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of cumulative series by convention (fixed values).
CUMULATIVE = ("_total", "_count", "_sum", "_bucket")
#: Severities that mean none was given (fixed values).
NO_SEVERITY = ("", "unknown", "unspecified", "none")
UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86_400, "w": 604_800, "y": 31_536_000}
#: A duration as text: a number and a unit.
DURATION = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([smhdwySMHDWY])\s*$"


# Buckets


def bucket_start(ts: Column, seconds: int) -> Column:
    """The start of the epoch-aligned bucket; right before the epoch too, for NTZ and (in a UTC session) LTZ input."""
    return F.window(ts, f"{seconds} seconds")["start"]


def in_range(ts: Column, start, end) -> Column:
    """Half-open membership, as plain comparisons that reach the Parquet scan."""
    return (ts >= F.lit(start)) & (ts < F.lit(end))


def is_sealed(bucket_end: Column, now: Column, grace_seconds: Column | int) -> Column:
    grace = F.lit(grace_seconds) if isinstance(grace_seconds, int) else grace_seconds
    return bucket_end + F.make_dt_interval(secs=grace) <= now


def floored(ts: Column, seconds: int) -> Column:
    """The bucket's start for scalar use, where a plan may hold several; in a UTC session. Floor division, right before the epoch too."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds) * seconds)


def watermark(now: Column, grace_seconds: Column | int, seconds: int) -> Column:
    """Buckets that end up to here are sealed."""
    grace = F.lit(grace_seconds) if isinstance(grace_seconds, int) else grace_seconds
    return floored(now - F.make_dt_interval(secs=grace), seconds)


def from_nanos(ns: Column) -> Column:
    """Timestamp of integer nanoseconds, cut to microseconds without passing through a double."""
    return F.timestamp_micros(F.floor(ns.cast("decimal(20,0)") / 1000).cast("bigint"))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def date_key(bucket: Column) -> Column:
    return F.date_format(bucket, "yyyy-MM-dd")


# Dimensions


def canonical(dims: Column) -> Column:
    """Keys in order, without null or empty values."""
    kept = F.filter(F.map_entries(dims), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    return F.map_from_entries(F.array_sort(kept))


def without(dims: Column, names) -> Column:
    names = list(names)
    return F.map_filter(dims, lambda k, v: ~k.isin(names)) if names else dims


def retained(dims: Column, name: str, default: str | None = None) -> Column:
    """A dimension's value; the default where it is absent or empty."""
    value = F.nullif(dims[name], F.lit(""))
    return F.coalesce(value, F.lit(default)) if default is not None else value


def assembled(columns: dict[str, Column]) -> Column:
    """A canonical map of typed dimension columns."""
    pairs = [x for k in sorted(columns) for x in (F.lit(k), columns[k])]
    return canonical(F.create_map(*pairs)) if pairs else F.create_map().cast("map<string,string>")


def identity(*parts: Column) -> Column:
    """A hash that any process computes alike; null and empty parts differ."""
    return F.md5(F.to_json(F.struct(*[p.cast("string").alias(f"p{i}") for i, p in enumerate(parts)])))


def dimension_hash(metric: Column, dims: Column) -> Column:
    return F.md5(F.to_json(F.struct(metric.alias("m"), F.map_entries(dims).alias("d"))))


# Scalars


def is_cumulative(metric: Column) -> Column:
    return metric.rlike("(" + "|".join(CUMULATIVE) + ")$")


def folded_severity(x: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return F.when(low.isin(list(NO_SEVERITY)), F.lit("unknown")).otherwise(low)


def positive_int(x: Column, default: int = 1) -> Column:
    n = x.try_cast("int")
    return F.when(n > 0, n).otherwise(F.lit(default))


def duration_seconds(x: Column) -> Column:
    """Seconds of ``3d``, ``72h``, ``1.5h``; null where it can't be read."""
    unit = F.lower(F.regexp_extract(x, DURATION, 2))
    factor = F.lit(None).cast("int")
    for u, n in UNITS.items():
        factor = F.when(unit == u, F.lit(n)).otherwise(factor)
    return F.regexp_extract(x, DURATION, 1).try_cast("double") * factor


def humanised(seconds: Column) -> Column:
    """The largest of d, h and m that measures the duration in whole numbers."""
    s = seconds.cast("bigint")
    out = F.concat(F.floor(s / 60).cast("string"), F.lit("m"))
    for n, u in ((3600, "h"), (86_400, "d")):
        out = F.when(s % n == 0, F.concat((F.floor(s / n)).cast("string"), F.lit(u))).otherwise(out)
    return out


def escaped_label(x: Column) -> Column:
    out = F.replace(x, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit('"'), F.lit('\\"'))
    return F.replace(out, F.lit("\n"), F.lit("\\n"))


def is_safe(retention: Column, grace: Column, interval: Column, margin: Column, width: Column | int = 0) -> Column:
    """Whether raw data outlives its rollup, strictly; an unknown retention isn't safe."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.coalesce(retention > grace + interval + margin + width, F.lit(False))
