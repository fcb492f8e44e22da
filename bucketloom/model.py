"""Time ranges, granularities, signals and the two record shapes."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import types as T

DAY = 86_400
SIGNALS = ("metrics", "logs", "traces")
#: Goes into every row and, with the package's version, into the writer version.
SCHEMA_VERSION = 1


@dataclass(frozen=True, order=True)
class TimeRange:
    """A half-open range [start, end) of UTC instants."""

    start: datetime
    end: datetime

    def __post_init__(self):
        for t in (self.start, self.end):
            if t.tzinfo is None or t.utcoffset() != timedelta(0):
                raise ValueError(f"{t} isn't in UTC")
        if self.start >= self.end:
            raise ValueError(f"empty range {self.start} .. {self.end}")

    def __contains__(self, t: datetime) -> bool:
        return self.start <= t < self.end

    @property
    def seconds(self) -> float:
        return (self.end - self.start).total_seconds()

    def halves(self) -> tuple[TimeRange, TimeRange]:
        """Two ranges that tile this one, cut at a whole second where there is one inside."""
        middle = self.start + (self.end - self.start) / 2
        whole = middle.replace(microsecond=0)
        middle = whole if self.start < whole < self.end else middle
        if not self.start < middle < self.end:
            raise ValueError(f"{self} can't be cut further")
        return TimeRange(self.start, middle), TimeRange(middle, self.end)


@dataclass(frozen=True)
class Granularity:
    """A bucket's width: seconds that divide a day or are whole days."""

    name: str
    seconds: int
    retain: str | None = None

    def __post_init__(self):
        if self.seconds <= 0:
            raise ValueError(f"{self.name}: width must be positive")
        if DAY % self.seconds and self.seconds % DAY:
            raise ValueError(f"{self.name}: {self.seconds} s neither divide a day nor are whole days")

    def floor(self, t: datetime) -> datetime:
        epoch = int(t.timestamp() // self.seconds) * self.seconds
        return datetime.fromtimestamp(epoch, UTC)

    def bucket(self, t: datetime) -> TimeRange:
        start = self.floor(t)
        return TimeRange(start, start + timedelta(seconds=self.seconds))

    def sealed(self, bucket_end: datetime, now: datetime, grace: timedelta) -> bool:
        return bucket_end + grace <= now

    def watermark(self, now: datetime, grace: timedelta) -> datetime:
        """Buckets ending up to here are sealed."""
        return self.floor(now - grace)

    def cold_start(self, now: datetime, horizon: timedelta) -> datetime:
        """Where a writer without a frontier begins."""
        return self.floor(now - horizon)

    def sealed_buckets(self, start: datetime, now: datetime, grace: timedelta, limit: int | None = None):
        """Sealed buckets from ``start`` on, oldest first."""
        step, at, n = timedelta(seconds=self.seconds), self.floor(start), 0
        until = self.watermark(now, grace)
        while at + step <= until and (limit is None or n < limit):
            yield TimeRange(at, at + step)
            at, n = at + step, n + 1


HOUR_1 = Granularity("1h", 3600, "90d")
DAY_1 = Granularity("1d", DAY, "730d")


@dataclass(frozen=True)
class SignalSpec:
    """What a signal is grouped by, and when its buckets are sealed."""

    name: str
    dimensions: tuple[str, ...]
    defaults: dict[str, str] = field(default_factory=dict)
    grace: timedelta = timedelta(0)
    sinks: tuple[str, ...] = ("parquet",)
    percentiles: tuple[float, ...] = ()


COMMON = ("service_name", "deployment_environment")
SPECS = {
    "metrics": SignalSpec("metrics", (*COMMON, "route", "method", "status"), {}, timedelta(minutes=2), ("prometheus", "parquet")),
    "logs": SignalSpec("logs", (*COMMON, "severity_text"), {"severity_text": "unknown"}, timedelta(minutes=10), ("loglines", "parquet")),
    "traces": SignalSpec("traces", (*COMMON, "root_service_name", "root_name", "status"), {"status": "ok"}, timedelta(minutes=20), ("prometheus", "parquet"), (50, 90, 95, 99)),
}


def spec_of(signal: str) -> SignalSpec:
    if signal not in SPECS:
        raise ValueError(f"unknown signal {signal!r}; known: {', '.join(SPECS)}")
    return SPECS[signal]


RAW = T.StructType(
    [
        T.StructField("signal", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("dimensions", T.MapType(T.StringType(), T.StringType(), True), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("identity", T.StringType(), False),
        T.StructField("signal_kind", T.StringType(), True),
    ]
)

ROLLUP = T.StructType(
    [
        T.StructField("signal", T.StringType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("bucket_start", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("dimensions", T.MapType(T.StringType(), T.StringType())),
        T.StructField("dimension_hash", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("sum", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("first", T.DoubleType()),
        T.StructField("last", T.DoubleType()),
        T.StructField("delta", T.DoubleType()),
        T.StructField("extras", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("schema_version", T.IntegerType()),
    ]
)
