"""Commands: run, probe, status, tiering, backfill."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import functions as F

from bucketloom.model import TimeRange, spec_of
from bucketloom.operators.relational import selected
from bucketloom.plans import config, pipeline, tiering
from bucketloom.plans.state import FAILED, Checkpoint
from bucketloom.session import session
from bucketloom.sinks import parquet, projections
from bucketloom.sinks.writer import SinkError, writer_version
from bucketloom.sources import shapes
from bucketloom.sources.http import HEALTH, SourceError, TelemetrySource, healthy

# Exit codes (fixed values).
OK, USAGE, BACKEND, BUCKET_FAILED, UNSAFE = 0, 2, 4, 5, 6


def instant(text: str) -> datetime:
    """ISO time; without an offset it is UTC."""
    t = datetime.fromisoformat(text)
    return t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)


def reader(spark, settings: config.Settings, signal: str, step: int):
    """Records of a window from the signal's backend, or from archived raw records where its url is a path."""
    url = settings.urls.get(signal)
    if not url:
        raise SourceError(f"no url for {signal}: set LOOM_{signal.upper()}_URL")

    def read(window: TimeRange):
        if "://" not in url or url.startswith("file:"):
            records = shapes.archived(spark, url).where(F.col("signal") == signal)
            return selected(records, F.coalesce("signal_kind", F.lit("")), F.col("dimensions"), projections.PREFIX)
        spark.dataSource.register(TelemetrySource)
        options = {"url": url, "signal": signal, "selector": settings.selectors[signal], "start": int(window.start.timestamp()), "end": int(-(-window.end.timestamp() // 1)), "step": step, "timeout": settings.timeout}
        text = spark.read.format("telemetry").options(**{k: str(v) for k, v in options.items()}).load()
        if signal == "metrics":
            return shapes.metric_records(shapes.parsed(text, shapes.EXPORT))
        if signal == "logs":
            return shapes.log_records(shapes.parsed(text, shapes.STREAMS))
        errors = spark.read.format("telemetry").options(**{k: str(v) for k, v in (options | {"selector": "{ status = error }"}).items()}).load()
        return shapes.trace_records(shapes.parsed(text, shapes.SEARCH), shapes.parsed(errors, shapes.SEARCH))

    return read


def _run(args, s: config.Settings, clock) -> int:
    spark, store, failed = session(), Checkpoint(s.state), 0
    for name in args.signal or s.signals:
        for g in s.granularities:
            r = pipeline.run(reader(spark, s, name, g.seconds), s.signals[name], g, store, clock, s.archive, s.destinations, horizon=s.horizon, dry_run=args.dry_run, strict_drift=s.strict_drift)
            print(r.summary())
            for w in r.warnings:
                print(f"warning: {w}", file=sys.stderr)
            for b, why in r.failed[:10]:
                print(f"  {b.start.isoformat()}: {why[:200]}")
            failed += len(r.failed)
    return BUCKET_FAILED if failed else OK


def _probe(args, s: config.Settings, clock) -> int:
    window = TimeRange(args.start, args.end)
    records = shapes.within(reader(session(), s, args.signal, 3600)(window), window).persist()
    try:
        for line in records.orderBy("timestamp", "identity").toJSON().toLocalIterator():
            print(line)
        told = records.agg(F.count("*").alias("n"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("total")).first()
        print(f"{args.signal}: {told['n']} records, value sum {told['total']:g}", file=sys.stderr)
    finally:
        records.unpersist()
    return OK


def _status(args, s: config.Settings, clock) -> int:
    store, now = Checkpoint(s.state), clock.now()
    for name, spec in s.signals.items():
        url = s.urls.get(name, "")
        up = healthy(url, HEALTH[name]) if "://" in url else bool(url)
        print(f"{name}: {url or 'no url'} ({'up' if up else 'down'}), grace {spec.grace}, writer {writer_version(spec)}")
        for g in s.granularities:
            at = store.frontier(name, g, writer_version(spec))
            print(f"  {g.name}: watermark {g.watermark(now, spec.grace).isoformat()}, frontier {at.isoformat() if at else 'none'}")
            for b in store.buckets(name, g, FAILED)[:10]:
                print(f"    failed {datetime.fromtimestamp(b['start'], UTC).isoformat()} after {b['attempts']} attempts: {b['error']}")
    return OK


def _tiering(args, s: config.Settings, clock) -> int:
    spark = session()
    live = {k: u for k, u in s.urls.items() if "://" in u and not u.startswith("file:")}
    found = tiering.safety(tiering.probe(spark, live.get("metrics"), live.get("logs")), s.granularities[0]).collect()
    for r in found:
        print(json.dumps(r.asDict()))
    for r in tiering.ratio(spark, s.archive, s.granularities[0].name).orderBy("signal").collect():
        print(json.dumps(r.asDict()))
    if args.expire:
        for g in s.granularities:
            keep = tiering.parse_duration(g.retain)
            if keep:
                print(f"{g.name}: {parquet.expire(spark, s.archive, g, f'{clock.now() - keep:%Y-%m-%d}')} days expired")
    return OK if all(r["safe"] for r in found) else UNSAFE


def _backfill(args, s: config.Settings, clock) -> int:
    spec_of(args.signal)
    if args.signal not in s.signals:
        raise ValueError(f"{args.signal} isn't enabled")
    spark, store, window = session(), Checkpoint(s.state), TimeRange(args.start, args.end)
    for g in s.granularities:
        r = pipeline.backfill(reader(spark, s, args.signal, g.seconds), s.signals[args.signal], g, store, clock, s.archive, window, s.destinations, s.strict_drift)
        print(r.summary())
        for w in r.warnings:
            print(f"warning: {w}", file=sys.stderr)
    return OK


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bucketloom")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="verb", required=True)
    x = sub.add_parser("run")
    x.add_argument("--signal", action="append")
    x.add_argument("--dry-run", action="store_true", help="count raw records and rows; write and commit nothing")
    for verb in ("probe", "backfill"):
        x = sub.add_parser(verb)
        x.add_argument("--signal", required=True)
        x.add_argument("--from", dest="start", type=instant, required=True)
        x.add_argument("--to", dest="end", type=instant, required=True)
    sub.add_parser("status")
    sub.add_parser("tiering").add_argument("--expire", action="store_true", help="delete archive dates beyond their granularity's retention")
    return p


def main(argv: list[str] | None = None, clock=None) -> int:
    args = parser().parse_args(argv)
    verbs = {"run": _run, "probe": _probe, "status": _status, "tiering": _tiering, "backfill": _backfill}
    try:
        return verbs[args.verb](args, config.load(args.config), clock or pipeline.SystemClock())
    except SourceError as e:
        print(f"backend: {e}", file=sys.stderr)
        return BACKEND
    except (ValueError, SinkError) as e:
        print(f"usage: {e}", file=sys.stderr)
        return USAGE


if __name__ == "__main__":
    sys.exit(main())
