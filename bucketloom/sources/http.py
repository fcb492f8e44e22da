"""Paged HTTP backends as a Spark data source: one input partition a bucket, read on the executors.

A full page means that the backend cut its answer; the window is then halved until pages aren't full. Rows outside the
half-open window are dropped, and an identity met twice in a bucket is an error.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from bucketloom.model import TimeRange

#: Windows up to this aren't halved any more.
LEAST_WINDOW = timedelta(seconds=2)
#: Rows of a page, by kind of backend (fixed values); 0 for no cap.
PAGES = {"metrics": 0, "logs": 4999, "traces": 1000}


class SourceError(RuntimeError):
    """A backend couldn't be read, or its answer breaks the contract."""


class SourceTruncated(SourceError):
    """A window that can't be halved further still fills a page."""


def get(base: str, path: str, params: dict, timeout: float = 30) -> bytes:
    url = f"{base.rstrip('/')}{path}?{urllib.parse.urlencode(params, doseq=True)}"
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.read()
    except urllib.error.HTTPError as e:
        raise SourceError(f"{path}: status {e.code}: {e.read()[:200]!r}") from e
    except OSError as e:
        raise SourceError(f"{path}: {e}") from e


def healthy(base: str, path: str, timeout: float = 5) -> bool:
    try:
        get(base, path, {}, timeout)
    except SourceError:
        return False
    return True


HEALTH = {"metrics": "/health", "logs": "/ready", "traces": "/ready"}


def complete(fetch, window: TimeRange, limit: int) -> Iterator[tuple[TimeRange, list]]:
    """Whole answers of windows that tile the given one; ``fetch(window, limit + 1)`` gives rows."""
    rows = fetch(window, limit + 1 if limit else 0)
    if limit and len(rows) > limit:
        if window.end - window.start <= LEAST_WINDOW:
            raise SourceTruncated(f"{window.start} .. {window.end} holds more than {limit} rows")
        for half in window.halves():
            yield from complete(fetch, half, limit)
        return
    yield window, rows


def read_window(fetch, window: TimeRange, limit: int, time_of, identity_of, usable=None) -> list:
    """All usable rows of the window, each once. Pages are judged full by what the backend sent, unusable rows included."""
    out, seen = [], set()
    for part, rows in complete(fetch, window, limit):
        for r in rows:
            if (usable is None or usable(r)) and time_of(r) in part:
                key = identity_of(r)
                if key in seen:
                    raise SourceError(f"identity {key!r} occurs twice in {window.start} .. {window.end}")
                seen.add(key)
                out.append(r)
    return out


def _nanos(t: datetime) -> int:
    d = t - datetime(1970, 1, 1, tzinfo=UTC)
    return (d.days * 86_400 + d.seconds) * 1_000_000_000 + d.microseconds * 1000


def _from_nanos(ns: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=ns // 1000)


def fetch_metrics(base: str, selector: str, window: TimeRange, timeout: float) -> list[str]:
    body = get(base, "/api/v1/export", {"match[]": selector, "start": window.start.timestamp(), "end": window.end.timestamp()}, timeout)
    return [x for x in body.decode().splitlines() if x.strip()]


def fetch_logs(base: str, selector: str, window: TimeRange, limit: int, timeout: float) -> list[tuple[dict, list]]:
    params = {"query": selector, "start": _nanos(window.start), "end": _nanos(window.end), "limit": limit, "direction": "forward"}
    data = json.loads(get(base, "/loki/api/v1/query_range", params, timeout)).get("data", {})
    if data.get("resultType") != "streams":
        raise SourceError(f"expected streams, got {data.get('resultType')!r}")
    return [(s["stream"], v) for s in data.get("result", []) for v in s["values"]]


def fetch_traces(base: str, query: str, window: TimeRange, limit: int, timeout: float) -> list[dict]:
    """Bounds widen to whole seconds; rows outside the window are dropped by the caller."""
    start = int(window.start.timestamp())
    end = -int(-window.end.timestamp() // 1)
    return json.loads(get(base, "/api/search", {"q": query, "start": start, "end": end, "limit": limit}, timeout)).get("traces") or []


class _Bucket(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))
        self.start, self.end = start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self) -> list[_Bucket]:
        start, end, step = (int(self.o[k]) for k in ("start", "end", "step"))
        return [_Bucket(a, min(a + step, end)) for a in range(start, end, step)]

    def read(self, partition: _Bucket) -> Iterator[tuple]:
        try:
            yield from self._read(partition)
        except SourceError as e:
            raise type(e)(f"{self.o['signal']}: {e}") from e

    def _read(self, partition: _Bucket) -> Iterator[tuple]:
        o, signal = self.o, self.o["signal"]
        window = TimeRange(datetime.fromtimestamp(partition.start, UTC), datetime.fromtimestamp(partition.end, UTC))
        limit, timeout, base = int(o.get("limit", PAGES[signal])), float(o.get("timeout", 30)), o["url"]
        if signal == "metrics":
            for line in fetch_metrics(base, o.get("selector", '{__name__!=""}'), window, timeout):
                yield (line,)
        elif signal == "logs":
            rows = read_window(
                lambda w, n: fetch_logs(base, o.get("selector", '{service_name=~".+"}'), w, n, timeout), window, limit,
                lambda r: _from_nanos(int(r[1][0])), lambda r: json.dumps([r[1][:2], sorted(r[0].items())]),
            )
            for stream, values in rows:
                yield (json.dumps({"data": {"resultType": "streams", "result": [{"stream": stream, "values": [values[:2]]}]}}),)
        else:
            rows = read_window(
                lambda w, n: fetch_traces(base, o.get("selector", "{}"), w, n, timeout), window, limit,
                lambda t: _from_nanos(int(t["startTimeUnixNano"])), lambda t: t["traceID"], lambda t: bool(t.get("traceID") and t.get("startTimeUnixNano")),
            )
            for t in rows:
                yield (json.dumps({"traces": [t]}),)


class TelemetrySource(DataSource):
    """``spark.read.format("telemetry")`` with url, signal, start, end and step (epoch seconds): one JSON response a row, for sources.shapes."""

    @classmethod
    def name(cls) -> str:
        return "telemetry"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))
