import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bucketloom import cli
from bucketloom.model import HOUR_1, RAW, SPECS, Granularity, TimeRange
from bucketloom.operators.rollup import rollup
from bucketloom.plans import pipeline, tiering
from bucketloom.plans.state import Checkpoint
from bucketloom.sinks import parquet, projections, writer

T0 = datetime(2026, 8, 27, 10, tzinfo=UTC)
H = timedelta(hours=1)
SPEC = SPECS["metrics"]
WRITER = writer.writer_version(SPEC)


def raw(spark, hours=range(6), bad=()):
    rows = [("metrics", T0 + h * H + timedelta(minutes=m), {"route": "/a"}, float(m), f"{h}-{0 if h in bad else m}", "hits_total") for h in hours for m in (1, 2, 3)]
    return spark.createDataFrame(rows, RAW)


@pytest.fixture
def setup(spark, tmp_path):
    store = Checkpoint(str(tmp_path / "state.sqlite"))
    clock = pipeline.FrozenClock(T0 + 4 * H + timedelta(minutes=2))
    go = lambda df, **k: pipeline.run(lambda w: df, SPEC, HOUR_1, store, clock, str(tmp_path / "archive"), {"prometheus": str(tmp_path / "lines")}, horizon=4 * H, **k)
    yield spark, store, clock, str(tmp_path / "archive"), go
    store.close()


def test_run_is_idempotent_and_resumes(setup):
    spark, store, clock, root, go = setup
    r = go(raw(spark))
    assert len(r.processed) == 4 and r.raw_records == 12 and r.rows == 4 and not r.failed
    before = [x.asDict() for x in parquet.read(spark, root).orderBy("bucket").collect()]
    assert len(before) == 4 and before[0]["count"] == 3
    assert go(raw(spark)).processed == []
    assert store.frontier("metrics", HOUR_1, WRITER) == T0 + 4 * H
    clock.advance(H)
    assert [b.start for b in go(raw(spark)).processed] == [T0 + 4 * H]
    assert [x.asDict() for x in parquet.read(spark, root).orderBy("bucket").collect()][:4] == before


def test_seal_edge(setup):
    spark, store, clock, root, go = setup
    clock.t -= timedelta(seconds=1)
    assert len(go(raw(spark)).processed) == 3
    assert store.frontier("metrics", HOUR_1, WRITER) == T0 + 3 * H


def test_a_bad_first_bucket_holds_the_frontier(setup):
    spark, store, clock, root, go = setup
    r = go(raw(spark, bad=(0,)))
    assert [b.start for b, _ in r.failed] == [T0] and len(r.processed) == 3
    assert store.frontier("metrics", HOUR_1, WRITER) == T0
    r = go(raw(spark))
    assert [b.start for b in r.processed] == [T0] and len(r.committed_before) == 3
    assert store.frontier("metrics", HOUR_1, WRITER) == T0 + 4 * H


def test_the_breaker_stops(setup):
    spark, store, clock, root, go = setup
    r = go(raw(spark, bad=range(6)))
    assert r.stopped and len(r.failed) == pipeline.BREAKER


def test_empty_buckets_are_answers_and_replace(setup):
    spark, store, clock, root, go = setup
    go(raw(spark))
    store.reset("metrics")
    r = go(raw(spark, hours=(0, 2)))
    assert len(r.processed) == 4
    assert sorted(x["bucket"] for x in parquet.read(spark, root).select("bucket").distinct().collect()) == [int((T0 + h * H).timestamp()) for h in (0, 2)]
    ratio = {x["signal"]: x for x in tiering.ratio(spark, root).collect()}
    assert ratio["metrics"]["files"] == 4 and ratio["metrics"]["empty_files"] == 2 and ratio["total"]["raw"] == 6 and ratio["metrics"]["reduction"] == 3


def test_dry_run_leaves_no_trace(setup):
    spark, store, clock, root, go = setup
    r = go(raw(spark), dry_run=True)
    assert r.raw_records == 12 and r.rows == 4
    assert store.frontier("metrics", HOUR_1, WRITER) is None and store.buckets("metrics", HOUR_1) == []


def test_leases(setup):
    spark, store, clock, root, go = setup
    b = TimeRange(T0, T0 + H)
    assert store.claim("metrics", HOUR_1, WRITER, b, clock.now())
    assert not store.claim("metrics", HOUR_1, WRITER, b, clock.now())
    assert store.claim("metrics", HOUR_1, "another", b, clock.now())
    r = go(raw(spark))
    assert r.locked == [b] and len(r.processed) == 3 and store.frontier("metrics", HOUR_1, WRITER) == T0
    assert store.claim("metrics", HOUR_1, WRITER, b, clock.now() + 2 * H)


def test_backfill_replaces(setup, tmp_path):
    spark, store, clock, root, go = setup
    go(raw(spark))
    changed = raw(spark).withColumn("value", F.col("value") * 10)
    r = pipeline.backfill(lambda w: changed, SPEC, HOUR_1, store, clock, root, TimeRange(T0 + H, T0 + 2 * H), {"prometheus": str(tmp_path / "lines")})
    assert len(r.processed) == 1 and not any("twice" in w for w in r.warnings)
    # Lines of the bucket were replaced, not added.
    assert spark.read.text(str(tmp_path / "lines")).count() == 8
    assert [x["last"] for x in parquet.read(spark, root).orderBy("bucket").collect()] == [3, 30, 3, 3]


def test_sinks_are_all_or_none(spark, tmp_path):
    rows = rollup(raw(spark, hours=(0,)), SPEC, HOUR_1)
    sinks = writer.sinks_of(["prometheus", "parquet"], str(tmp_path / "a"), {"prometheus": str(tmp_path / "lines")})
    sinks["prometheus"] = writer.Sink(lambda df: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(writer.SinkError, match="prometheus failed after parquet"):
        writer.write_all(rows, sinks)


def test_a_sink_without_destination_fails_before_anything_is_claimed(setup):
    spark, store, clock, root, go = setup
    with pytest.raises(writer.SinkError, match="no destination"):
        pipeline.run(lambda w: raw(spark), SPEC, HOUR_1, store, clock, root, horizon=4 * H)
    assert store.buckets("metrics", HOUR_1) == [] and store.frontier("metrics", HOUR_1, WRITER) is None
    assert not writer.sinks_of(["loglines"], root, {"loglines": "http://localhost/push"})["loglines"].replaces_on_rewrite


def test_a_failed_run_sends_each_line_once(setup, tmp_path):
    spark, store, clock, root, go = setup
    r = go(raw(spark, bad=(0,)))  # fails as a whole, then bucket by bucket
    assert len(r.processed) == 3 and spark.read.text(str(tmp_path / "lines")).count() == 6
    go(raw(spark))
    assert spark.read.text(str(tmp_path / "lines")).count() == 8


def test_the_source_is_read_once_and_the_run_tells_drift(setup):
    spark, store, clock, root, go = setup
    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    once = raw(spark, range(4)).mapInArrow(counted, RAW).withColumn("dimensions", F.expr("map('route', '/a', 'zone', 'z')"))
    r = go(once)
    assert len(r.processed) == 4 and n.value == 12
    assert len([w for w in r.warnings if "no record has deployment_environment" in w and "service_name" in w and "zone (3)" in w]) == 4
    store.reset("metrics")
    assert len(go(once, strict_drift=True).failed) == pipeline.BREAKER


def test_samples_of_one_instant_are_told(setup):
    spark, store, clock, root, go = setup
    rows_ = [("metrics", T0, {"route": "/a"}, float(i), f"k:1:{i:09d}", "hits_total") for i in range(3)]
    assert any("hits_total has 3 samples" in w for w in go(spark.createDataFrame(rows_, RAW)).warnings)


def test_the_writer_changes_with_the_signal():
    from dataclasses import replace

    assert len({writer.writer_version(x) for x in (SPEC, replace(SPEC, dimensions=("route",)), replace(SPEC, percentiles=(50,)), replace(SPEC, sinks=("parquet",)))}) == 4


def test_projections(spark):
    rows = rollup(raw(spark, hours=(0,)), SPEC, HOUR_1)
    lines = sorted(r.value for r in projections.prometheus_lines(rows).collect())
    ms = int(T0.timestamp() * 1000)
    assert lines == [f'rollup_hits_total_{a}{{granularity="1h",rollup_schema="1",route="/a",tier="cold"}} {v} {ms}' for a, v in (("count", "3.0"), ("delta", "2.0"))]
    (entry,) = projections.log_lines(rows).collect()
    body = json.loads(entry.line)
    assert list(body) == sorted(body) and body["events"] == 6 and body["bucket_start"] == "2026-08-27T10:00:00Z" and entry.stream["signal"] == "metrics"


def test_paths():
    assert parquet.bucket_path("r", "metrics", "1h", TimeRange(T0, T0 + H)) == "r/signal=metrics/granularity=1h/date=2026-08-27/bucket=1787824800"


def test_expiry(setup):
    spark, store, clock, root, go = setup
    go(raw(spark))
    assert parquet.expire(spark, root, HOUR_1, "2026-08-27") == 0 and parquet.expire(spark, root, HOUR_1, "2026-08-28") == 1


def test_retention_texts(spark):
    assert tiering.metrics_retention('flag{name="retentionPeriod", value="3d", is_set="true"} 1') == ("3d", False)
    config = "limits_config:\n  retention_period: 72h\n  retention_stream:\n  - selector: '{tier=\"cold\"}'\n    priority: 1\n    period: 2160h\n"
    assert tiering.logs_retention(config) == ("72h", "2160h")
    found = {r["signal"]: r["safe"] for r in tiering.safety(tiering.probe(spark, None, None), HOUR_1).collect()}
    assert found == {"metrics": False, "logs": False, "traces": True}
    daily = tiering.safety(tiering.probe(spark, None, None), Granularity("1d", 86_400), count_width=True).where("signal = 'traces'").first()
    assert daily["safe"] is False
    assert [tiering.parse_duration(x) for x in ("72h", "90m", "x", None)] == [timedelta(days=3), timedelta(minutes=90), None, None]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    raw(spark).write.parquet(str(tmp_path / "raw"))
    for k, v in (("METRICS_URL", tmp_path / "raw"), ("ARCHIVE", tmp_path / "archive"), ("STATE", tmp_path / "s.sqlite")):
        monkeypatch.setenv(f"LOOM_{k}", str(v))
    clock = pipeline.FrozenClock(T0 + 3 * H)
    assert cli.main(["run", "--signal", "metrics"], clock) == cli.USAGE  # its projection has no destination
    assert not (tmp_path / "archive").exists()
    monkeypatch.setenv("LOOM_SINK_PROMETHEUS", str(tmp_path / "lines"))
    assert cli.main(["run", "--signal", "metrics"], clock) == cli.OK
    assert spark.read.text(str(tmp_path / "lines")).count() > 0
    assert "metrics/1h: 23 processed" in capsys.readouterr().out
    assert cli.main(["probe", "--signal", "metrics", "--from", "2026-08-27T10:00", "--to", "2026-08-27T13:00+02:00"], clock) == cli.OK
    told = capsys.readouterr()
    assert len(told.out.splitlines()) == 3 and "3 records, value sum 6" in told.err
    (tmp_path / "c.json").write_text(json.dumps({"signals": {"metrics": {"dimensions": ["zone"], "sinks": ["parquet"]}}}))
    assert cli.main(["--config", str(tmp_path / "c.json"), "backfill", "--signal", "metrics", "--from", "2026-08-27T10:00", "--to", "2026-08-27T11:00"], clock) == cli.OK
    hour = parquet.read(spark, str(tmp_path / "archive")).where("granularity = '1h' AND bucket = 1787824800").collect()
    assert [r.dimensions for r in hour] == [{}]
    assert cli.main(["--config", str(tmp_path / "c.json"), "backfill", "--signal", "logs", "--from", "2026-08-27T10:00", "--to", "2026-08-27T11:00"], clock) == cli.USAGE
    capsys.readouterr()
    assert cli.main(["probe", "--signal", "metrics", "--from", "2026-08-27", "--to", "2026-08-27"], clock) == cli.USAGE
    assert cli.main(["run", "--signal", "logs"], clock) == cli.BACKEND
    assert cli.main(["status"], clock) == cli.OK
    assert cli.main(["tiering"], clock) == cli.UNSAFE
