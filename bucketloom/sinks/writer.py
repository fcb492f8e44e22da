"""All sinks or none: a bucket counts as written only when every sink has taken it."""

from __future__ import annotations

import hashlib
import urllib.request
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.model import SCHEMA_VERSION, SignalSpec, TimeRange
from bucketloom.operators.relational import assert_unique
from bucketloom.sinks import parquet, projections

VERSION = "2"
#: By which text projections are parted, so that a bucket is replaced on its own.
BY_BUCKET = ("signal", "granularity", "bucket")
_PLACE = ("signal", "granularity", "bucket_start")


class SinkError(RuntimeError):
    pass


@dataclass(frozen=True)
class Sink:
    write: Callable[[DataFrame], None]
    #: Whether writing a bucket again leaves what writing it once does.
    replaces_on_rewrite: bool = True
    #: Takes a bucket's earlier rows away where it now has none.
    clear: Callable[[str, str, list[TimeRange]], None] | None = None


def writer_version(spec: SignalSpec) -> str:
    """Changes with whatever changes the output: shape, code, and the signal's whole configuration."""
    told = repr(sorted(asdict(spec).items()))
    return f"v{VERSION}-s{SCHEMA_VERSION}-{'+'.join(ordered(spec.sinks))}-{hashlib.sha256(told.encode()).hexdigest()[:8]}"


def ordered(sinks) -> list[str]:
    """The archive first, whatever the configuration's order, and always there."""
    return ["parquet", *[s for s in dict.fromkeys(sinks) if s != "parquet"]]


def posted(url: str, begin: str, between: str, end: str, kind: str, batch: int = 5000) -> Callable:
    """A foreachPartition function that posts lines in batches."""

    def run(rows):
        held: list[str] = []

        def send():
            if held:
                body = (begin + between.join(held) + end).encode()
                with urllib.request.urlopen(urllib.request.Request(url, body, {"Content-Type": kind}, method="POST"), timeout=30) as r:
                    r.read()
                held.clear()

        for r in rows:
            held.append(r["value"])
            if len(held) >= batch:
                send()
        send()

    return run


def _lines(rows: DataFrame) -> DataFrame:
    return projections.prometheus_lines(rows, carry=_PLACE)


def _entries(rows: DataFrame) -> DataFrame:
    lines = projections.log_lines(rows, carry=_PLACE)
    return lines.select(*_PLACE, F.to_json(F.struct("stream", F.array(F.array("ts_ns", "line")).alias("values"))).alias("value"))


def _text(make: Callable[[DataFrame], DataFrame], to: str, begin: str, between: str, end: str, kind: str) -> Sink:
    """Lines posted to a url, or kept as text under a path, where each bucket's lines replace its earlier ones."""
    if to.startswith(("http://", "https://")):
        return Sink(lambda rows: make(rows).foreachPartition(posted(to, begin, between, end, kind)), replaces_on_rewrite=False)

    def write(rows: DataFrame) -> None:
        lines = make(rows).withColumn("bucket", F.unix_seconds("bucket_start")).drop("bucket_start").repartition(*BY_BUCKET)
        lines.write.partitionBy(*BY_BUCKET).option("partitionOverwriteMode", "dynamic").mode("overwrite").text(to)

    def clear(signal: str, granularity: str, buckets: list[TimeRange]) -> None:
        parquet.delete([f"{to}/signal={signal}/granularity={granularity}/bucket={int(b.start.timestamp())}" for b in buckets])

    return Sink(write, clear=clear)


def sinks_of(names, root: str, destinations: dict[str, str] | None = None) -> dict[str, Sink]:
    """The named sinks, the archive under ``root`` first. A projection without a destination is an error, not a sink that takes everything."""
    destinations = destinations or {}
    out: dict[str, Sink] = {}
    for name in ordered(names):
        if name == "parquet":
            out[name] = Sink(lambda rows: parquet.write(rows, root))
        elif name not in ("prometheus", "loglines"):
            raise SinkError(f"unknown sink {name!r}; known: parquet, prometheus, loglines")
        elif not destinations.get(name):
            raise SinkError(f"sink {name} has no destination: name one under destinations, or in LOOM_SINK_{name.upper()}")
        elif name == "prometheus":
            out[name] = _text(_lines, destinations[name], "", "\n", "\n", "text/plain")
        else:
            out[name] = _text(_entries, destinations[name], '{"streams":[', ",", "]}", "application/json")
    return out


def write_all(rows: DataFrame, sinks: dict[str, Sink]) -> int:
    """Rows written. The rollup is kept between sinks, so it is computed once."""
    rows = rows.persist()
    try:
        assert_unique(rows, ["bucket_start", "metric", "dimension_hash"], "duplicate rollup rows")
        done: list[str] = []
        for name, sink in sinks.items():
            try:
                sink.write(rows)
            except Exception as e:
                raise SinkError(f"{name} failed after {', '.join(done) or 'none'} succeeded: {e}") from e
            done.append(name)
        return rows.count()
    finally:
        rows.unpersist()
