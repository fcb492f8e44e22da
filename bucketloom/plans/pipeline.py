"""Runs: every pending sealed bucket of a signal in one distributed plan, committed bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.model import Granularity, SignalSpec, TimeRange
from bucketloom.operators import relational as R
from bucketloom.operators.rollup import rollup
from bucketloom.plans.state import COMMITTED, Checkpoint
from bucketloom.sinks import parquet
from bucketloom.sinks.writer import Sink, SinkError, ordered, sinks_of, write_all, writer_version
from bucketloom.sources.shapes import within

#: After so many failures in a row a signal's run stops.
BREAKER = 3
HORIZON = timedelta(hours=24)


class FrozenClock:
    """A clock that only goes forward, by hand."""

    def __init__(self, now: datetime):
        self.t = now

    def now(self) -> datetime:
        return self.t

    def advance(self, d: timedelta) -> None:
        if d < timedelta(0):
            raise ValueError("a clock doesn't go back")
        self.t += d


class SystemClock:
    def now(self) -> datetime:
        return datetime.now(UTC)


@dataclass
class Report:
    signal: str
    granularity: str
    processed: list[TimeRange] = field(default_factory=list)
    committed_before: list[TimeRange] = field(default_factory=list)
    locked: list[TimeRange] = field(default_factory=list)
    failed: list[tuple[TimeRange, str]] = field(default_factory=list)
    raw_records: int = 0
    rows: int = 0
    stopped: bool = False
    #: What doesn't stop a run but should be known: drift, samples of one instant, sinks that were given a bucket again.
    warnings: list[str] = field(default_factory=list)

    def summary(self) -> str:
        return f"{self.signal}/{self.granularity}: {len(self.processed)} processed, {len(self.committed_before)} done before, {len(self.locked)} held elsewhere, {len(self.failed)} failed, {self.rows} rows"


Read = Callable[[TimeRange], DataFrame]


def _runs(buckets: list[TimeRange]) -> list[TimeRange]:
    """Neighbouring buckets as one range, so that the scan gets few plain range predicates."""
    out: list[TimeRange] = []
    for b in buckets:
        if out and out[-1].end == b.start:
            out[-1] = TimeRange(out[-1].start, b.end)
        else:
            out.append(b)
    return out


def _read(read: Read, buckets: list[TimeRange]) -> DataFrame:
    out = None
    for r in _runs(buckets):
        part = within(read(r), r)
        out = part if out is None else out.unionByName(part)
    return out


def _notes(records: DataFrame, spec: SignalSpec, g: Granularity, strict: bool) -> list[str]:
    """What the records show besides their rows. A dimension that a whole bucket lacks is an error where drift is strict."""
    out = []
    at = F.floor(F.unix_seconds("timestamp") / g.seconds) * g.seconds
    for r in R.drift_by_bucket(records, at, list(spec.dimensions)).orderBy("bucket").collect():
        said = [f"no record has {', '.join(r['missing'])}"] if r["missing"] else []
        said += [f"dimensions that aren't configured: {', '.join(f'{x.key} ({x.n})' for x in r['unexpected'])}"] if r["unexpected"] else []
        text = f"{spec.name}/{g.name} {datetime.fromtimestamp(r['bucket'], UTC).isoformat()}: {'; '.join(said)}"
        if strict and r["missing"]:
            raise SinkError(f"strict drift: {text}")
        out.append(text)
    if spec.name == "metrics":  # an identity ends in the sample's number among those of its series and instant
        nth = F.regexp_extract("identity", ":([0-9]{9})$", 1).try_cast("int")
        twice = records.select("signal_kind", nth.alias("nth")).where("nth > 0").groupBy("signal_kind").agg((F.count("*") + F.count_if(F.col("nth") == 1)).alias("n"))
        out += [f"metrics: {r['signal_kind']} has {r['n']} samples that share an instant with another of their series" for r in twice.orderBy("signal_kind").collect()]
    return out


def _process(read: Read, spec: SignalSpec, g: Granularity, buckets: list[TimeRange], root: str, sinks: dict[str, Sink], report: Report, strict: bool) -> dict[int, tuple[int, int]]:
    """Writes the buckets; raw records and rows of each, by its start. The source is read once: what is checked is what is written."""
    fetched = _read(read, buckets)
    spark = fetched.sparkSession
    with parquet.staging(spark, root) as place:
        fetched.write.parquet(place)
        records = spark.read.schema(fetched.schema).parquet(place)
        at = F.floor(F.unix_seconds("timestamp") / g.seconds) * g.seconds
        R.assert_unique(records.withColumn("bucket", at), ["bucket", "identity"], "identities that occur twice in a bucket")
        notes = _notes(records, spec, g, strict)
        rows = rollup(records, spec, g).persist()
        try:
            write_all(rows, sinks)
            found = {r["s"]: (r["raw"], r["n"]) for r in rows.groupBy(F.unix_seconds("bucket_start").alias("s")).agg(F.sum("count").alias("raw"), F.count("*").alias("n")).collect()}
        finally:
            rows.unpersist()
    # An empty sealed bucket is an answer too.
    empty = [b for b in buckets if int(b.start.timestamp()) not in found]
    parquet.write_empty(spark, root, spec.name, g, empty)
    for sink in sinks.values():
        if sink.clear is not None:
            sink.clear(spec.name, g.name, empty)
    report.warnings += notes
    return found


def _given_again(sinks: dict[str, Sink], buckets: list[TimeRange]) -> list[str]:
    names = [n for n, s in sinks.items() if not s.replaces_on_rewrite]
    return [f"{', '.join(names)} may hold rows of {len(buckets)} buckets twice: they were sent before and can't be replaced"] if names and buckets else []


def run(read: Read, spec: SignalSpec, g: Granularity, store: Checkpoint, clock, root: str, destinations: dict[str, str] | None = None, horizon: timedelta = HORIZON, limit: int | None = None, dry_run: bool = False, strict_drift: bool = False) -> Report:
    """Processes what is sealed and not committed. One plan for all; if it fails, bucket by bucket, to find the bad ones."""
    report, now, writer = Report(spec.name, g.name), clock.now(), writer_version(spec)
    sinks = sinks_of(spec.sinks, root, destinations)  # before anything is claimed
    start = store.frontier(spec.name, g, writer)
    if start is None:
        start = g.cold_start(now, horizon)
        if not dry_run:
            start = store.seed(spec.name, g, writer, start)
    pending: list[TimeRange] = []
    again: list[TimeRange] = []
    for b in g.sealed_buckets(start, now, spec.grace, limit):
        if store.status(spec.name, g, writer, b.start) == COMMITTED:
            report.committed_before.append(b)
        elif dry_run or store.claim(spec.name, g, writer, b, now):
            pending.append(b)
            if not dry_run and store.attempts(spec.name, g, writer, b.start) > 1:
                again.append(b)
        else:
            report.locked.append(b)
    if not pending:
        return report
    if dry_run:
        records = _read(read, pending).persist()
        try:
            report.processed, report.raw_records, report.rows = pending, records.count(), rollup(records, spec, g).count()
            report.warnings += _notes(records, spec, g, strict=False)
        finally:
            records.unpersist()
        return report

    def commit(buckets: list[TimeRange], found: dict[int, tuple[int, int]]) -> None:
        for b in buckets:
            raw, n = found.get(int(b.start.timestamp()), (0, 0))
            store.commit(spec.name, g, writer, b, clock.now(), n)
            report.processed.append(b)
            report.raw_records += raw
            report.rows += n

    try:
        report.warnings += _given_again(sinks, again)
        commit(pending, _process(read, spec, g, pending, root, sinks, report, strict_drift))
        return report
    except Exception as e:
        if len(pending) == 1:
            store.fail(spec.name, g, writer, pending[0], str(e))
            report.failed.append((pending[0], str(e)))
            return report
    in_row = 0
    report.warnings += _given_again(sinks, [b for b in pending if b not in again])
    for i, b in enumerate(pending):
        try:
            commit([b], _process(read, spec, g, [b], root, sinks, report, strict_drift))
            in_row = 0
        except Exception as e:
            store.fail(spec.name, g, writer, b, str(e))
            report.failed.append((b, str(e)))
            in_row += 1
            if in_row >= BREAKER:
                report.stopped = True
                for rest in pending[i + 1 :]:
                    store.fail(spec.name, g, writer, rest, "not tried: the run stopped")
                break
    return report


def backfill(read: Read, spec: SignalSpec, g: Granularity, store: Checkpoint, clock, root: str, window: TimeRange, destinations: dict[str, str] | None = None, strict_drift: bool = False) -> Report:
    """Reprocesses the sealed buckets of a window, committed or not; each bucket's file is replaced."""
    report, writer, now = Report(spec.name, g.name), writer_version(spec), clock.now()
    sinks = sinks_of(spec.sinks, root, destinations)
    store.seed(spec.name, g, writer, g.floor(window.start))
    store.reset(spec.name, TimeRange(g.floor(window.start), window.end))
    wanted = [b for b in g.sealed_buckets(window.start, now, spec.grace) if b.start < window.end]
    claimed = [b for b in wanted if store.claim(spec.name, g, writer, b, now)]
    if not claimed:
        return report
    report.warnings += _given_again(sinks, claimed)
    found = _process(read, spec, g, claimed, root, sinks, report, strict_drift)
    for b in claimed:
        raw, n = found.get(int(b.start.timestamp()), (0, 0))
        store.commit(spec.name, g, writer, b, clock.now(), n)
        report.processed.append(b)
        report.raw_records += raw
        report.rows += n
    return report


__all__ = ["FrozenClock", "Report", "SystemClock", "backfill", "ordered", "run"]
