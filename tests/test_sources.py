import json
import threading
from datetime import UTC, datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from bucketloom.model import TimeRange
from bucketloom.operators.relational import selected
from bucketloom.sources import http, shapes

T0 = datetime(2026, 8, 27, 10, tzinfo=UTC)
HOUR = TimeRange(T0, T0 + timedelta(hours=1))
MS = int(T0.timestamp() * 1000)


def put(path, lines):
    path.write_text("\n".join(json.dumps(x) for x in lines))
    return str(path)


def test_metric_export(spark, tmp_path):
    series = [
        {"metric": {"__name__": "hits_total", "route": "/a", "job": "j", "instance": "i"}, "values": [1, None, 3], "timestamps": [MS, MS + 1, MS + 2]},
        {"metric": {"__name__": "many_total"}, "values": list(range(12, 0, -1)), "timestamps": [MS] * 12},
        {"metric": {"route": "/nameless"}, "values": [1], "timestamps": [MS]},
    ]
    rows = shapes.metric_records(shapes.read_lines(spark, put(tmp_path / "e.jsonl", series), shapes.EXPORT)).orderBy("signal_kind", "timestamp", "identity").collect()
    assert [(r.signal_kind, r.value) for r in rows] == [("hits_total", 1), ("hits_total", 3), *[("many_total", v) for v in range(1, 13)]]
    assert rows[0].dimensions == {"route": "/a"} and len({r.identity for r in rows}) == 14
    assert rows[0].timestamp.replace(tzinfo=UTC) == T0


def test_lengths_must_agree(spark, tmp_path):
    bad = [{"metric": {"__name__": "x"}, "values": [1, 2, 3], "timestamps": [MS, MS]}]
    with pytest.raises(Exception, match="differ in length"):
        shapes.metric_records(shapes.read_lines(spark, put(tmp_path / "b.jsonl", bad), shapes.EXPORT)).collect()


def test_logs(spark, tmp_path):
    ns = MS * 10**6
    doc = {"data": {"resultType": "streams", "result": [
        {"stream": {"service_name": "s", "severity_text": "ERROR", "dedup_count": "20", "trace_id": "t"}, "values": [[str(ns), "a"], [str(ns), "b"]]},
        {"stream": {"service_name": "s", "detected_level": "info", "dedup_count": "x"}, "values": [[str(ns + 1_500), "c"]]},
    ]}}
    rows = shapes.log_records(shapes.read_document(spark, put(tmp_path / "l.json", [doc]), shapes.STREAMS)).orderBy("value", "identity").collect()
    assert [(r.signal_kind, r.value) for r in rows] == [("info", 1), ("ERROR", 20), ("ERROR", 20)]
    assert rows[1].dimensions == {"service_name": "s", "severity_text": "ERROR"} and rows[1].identity != rows[2].identity
    with pytest.raises(Exception, match="expected streams"):
        shapes.log_records(shapes.read_document(spark, put(tmp_path / "m.json", [{"data": {"resultType": "matrix", "result": []}}]), shapes.STREAMS)).collect()


def test_traces(spark, tmp_path):
    ns = str(MS * 10**6)
    found = {"traces": [{"traceID": "a", "rootServiceName": "s", "rootTraceName": "GET", "startTimeUnixNano": ns, "durationMs": 5}, {"traceID": "b", "startTimeUnixNano": ns}, {"traceID": "c"}, {"startTimeUnixNano": ns}]}
    bad = {"traces": [{"traceID": "b", "startTimeUnixNano": ns}]}
    read = lambda name, x: shapes.read_document(spark, put(tmp_path / name, [x]), shapes.SEARCH)
    rows = {r.identity: r for r in shapes.trace_records(read("t.json", found), read("b.json", bad)).collect()}
    assert {k: (r.dimensions["status"], r.value) for k, r in rows.items()} == {"a": ("ok", 5), "b": ("error", 0)}


def test_selector_and_window(spark):
    from pyspark.sql import functions as F

    df = spark.sql("SELECT 'rollup_x' AS n, map('tier', 'hot') AS d UNION ALL SELECT 'x', map('tier', 'cold') UNION ALL SELECT 'y', map('a', 'b')")
    assert [r.n for r in selected(df, F.col("n"), F.col("d"), "rollup_").collect()] == ["y"]


def fake(rows):
    return lambda w, n: [r for r in rows if w.start <= r[0] <= w.end][: n or None]  # inclusive end, capped


def test_full_pages_are_halved_and_ends_are_open():
    rows = [(T0 + timedelta(seconds=10 * i), i) for i in range(361)]
    got = http.read_window(fake(rows), HOUR, 50, lambda r: r[0], lambda r: r[1])
    assert [r[1] for r in got] == list(range(360))


def test_unusable_rows_count_towards_a_full_page():
    rows = [(T0 + timedelta(seconds=i % 3600), i if i != 7 else None) for i in range(3000)]
    got = http.read_window(fake(sorted(rows, key=lambda r: r[0])), HOUR, 1000, lambda r: r[0], lambda r: r[1], lambda r: r[1] is not None)
    assert len(got) == 2999


def test_malformed_lines_fail(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"metric": {"__name__": "a"}, "values": [1], "timestamps": [1]}\n\n{"metric": {"__name__"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        shapes.read_lines(spark, str(tmp_path / "x.jsonl"), shapes.EXPORT).collect()


def test_a_window_that_stays_full_fails():
    rows = [(T0 + timedelta(milliseconds=i), i) for i in range(100)]
    with pytest.raises(http.SourceTruncated):
        http.read_window(fake(rows), HOUR, 5, lambda r: r[0], lambda r: r[1])


def test_identities_are_checked_over_the_whole_window():
    rows = [(T0 + timedelta(seconds=i), i % 359) for i in range(360)]
    with pytest.raises(http.SourceError, match="twice"):
        http.read_window(fake(rows), HOUR, 50, lambda r: r[0], lambda r: r[1])


@pytest.fixture
def backend():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            from urllib.parse import parse_qs, urlparse

            u = urlparse(self.path)
            q = {k: v[0] for k, v in parse_qs(u.query).items()}
            code, body = 200, b"ok"
            if u.path == "/api/search":
                all_ = [{"traceID": f"t{i}", "rootTraceName": "GET", "startTimeUnixNano": str((MS // 1000 + i * 5) * 10**9), "durationMs": i} for i in range(1440)]
                hit = [t for i, t in enumerate(all_) if int(q["start"]) <= MS // 1000 + i * 5 <= int(q["end"]) and ("error" not in q["q"] or i % 10 == 0)]
                body = json.dumps({"traces": hit[: int(q["limit"])]}).encode()
            elif u.path == "/down":
                code = 503
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_http_data_source(spark, backend, monkeypatch):
    from bucketloom.cli import reader
    from bucketloom.plans.config import Settings

    monkeypatch.setitem(http.PAGES, "traces", 1000)
    window = TimeRange(T0, T0 + timedelta(hours=2))
    df = shapes.within(reader(spark, Settings(urls={"traces": backend}), "traces", 3600)(window), window)
    rows = df.collect()
    assert len(rows) == 1440 and sum(r.dimensions["status"] == "error" for r in rows) == 144


def test_health_and_errors(backend):
    assert http.healthy(backend, "/ready") and not http.healthy(backend, "/down") and not http.healthy("http://127.0.0.1:9", "/ready")
    with pytest.raises(http.SourceError, match="503"):
        http.get(backend, "/down", {})
