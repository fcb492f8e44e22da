from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bucketloom.model import HOUR_1, RAW, SPECS
from bucketloom.operators import relational as R
from bucketloom.operators.rollup import percentile_points, rollup
from bucketloom.streaming.rollup import increase_of

T0 = datetime(2026, 8, 27, 10, tzinfo=UTC)


def records(spark, signal, rows):
    return spark.createDataFrame([(signal, T0 + timedelta(seconds=s), d, float(v), f"{i:04d}", kind) for i, (s, d, v, kind) in enumerate(rows)], RAW)


def rolled(spark, signal, rows):
    return [r.asDict() for r in rollup(records(spark, signal, rows), SPECS[signal], HOUR_1).orderBy("bucket_start", "metric", F.to_json("dimensions")).collect()]


def plain_delta(values):
    return sum(b - a if b >= a else b for a, b in zip(values, values[1:]))


@pytest.mark.parametrize(("values", "delta"), [([10, 20, 30], 20), ([500], 0), ([100, 120, 10, 30], 50), ([50, 5, 20, 3], 23), ([7, 7, 7, 7], 0)])
def test_counter_increase(spark, values, delta):
    (r,) = rolled(spark, "metrics", [(60 * i, {"service_name": "svc"}, v, "hits_total") for i, v in enumerate(values)])
    assert r["delta"] == delta == plain_delta(values) and r["count"] == len(values) and r["sum"] == sum(values)
    assert r["extras"]["is_counter"] == 1 and (r["first"], r["last"]) == (values[0], values[-1])


@settings(max_examples=10, deadline=None)
@given(values=st.lists(st.integers(0, 50), min_size=1, max_size=12))
def test_both_forms_of_increase_agree(spark, values):
    df = spark.createDataFrame([(i, str(i), float(v)) for i, v in enumerate(values)], "timestamp int, identity string, value double")
    got = df.agg(increase_of(F.collect_list(F.struct("timestamp", "identity", "value"))).alias("x")).first()["x"]
    assert got == plain_delta(values)


def test_gauges_have_no_increase_and_nan_is_left_out(spark):
    (r,) = rolled(spark, "metrics", [(0, {}, 5, "temp"), (1, {}, 9, "temp"), (2, {}, float("nan"), "temp")])
    assert (r["delta"], r["extras"]["avg"], r["extras"]["is_counter"], r["count"]) == (0, 7, 0, 2)


def test_first_sample_of_a_bucket_grows_nothing(spark):
    rows = rolled(spark, "metrics", [(3599, {}, 10, "x_total"), (3600, {}, 30, "x_total"), (3601, {}, 31, "x_total")])
    assert [r["delta"] for r in rows] == [0, 1]


def test_unconfigured_dimensions_collapse(spark):
    (r,) = rolled(spark, "metrics", [(0, {"route": "/a", "pod": "1"}, 1, "x_total"), (1, {"route": "/a", "pod": "2"}, 2, "x_total")])
    assert r["dimensions"] == {"route": "/a"} and r["count"] == 2


def test_logs_fold_severities_and_weigh_by_events(spark):
    rows = rolled(spark, "logs", [(i, {"severity_text": s}, 4, s) for i, s in enumerate(["ERROR", "Error", " error", "", "none", "unspecified"])])
    assert [(r["dimensions"]["severity_text"], r["count"], r["sum"], r["extras"]["dedup_factor"]) for r in rows] == [("error", 3, 12, 4), ("unknown", 3, 12, 4)]


def test_traces_are_parted_by_status(spark):
    rows = rolled(spark, "traces", [(0, {"status": "ok"}, 1, "trace"), (1, {}, 2, "trace"), (2, {"status": "error"}, 100, "trace"), (3, {"status": "error"}, 200, "trace")])
    assert [(r["dimensions"]["status"], r["count"], r["extras"]["p50"]) for r in rows] == [("error", 2, 150), ("ok", 2, 1.5)]
    with pytest.raises(Exception, match="unexpected trace status"):
        rolled(spark, "traces", [(0, {"status": "odd"}, 1, "trace")])


def test_percentiles(spark):
    assert percentile_points([99, 50, 50]) == [50, 99]
    with pytest.raises(ValueError):
        percentile_points([101])
    (r,) = rolled(spark, "traces", [(i, {}, v, "trace") for i, v in enumerate([10, 20, 30, 40])])
    assert r["extras"]["p50"] == 25 and r["extras"]["p99"] == pytest.approx(39.7)


def test_one_exchange_serves_window_and_aggregation(spark):
    df = rollup(records(spark, "metrics", [(0, {"route": "/a"}, 1, "x_total")]), SPECS["metrics"], HOUR_1)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_drift_and_guards(spark):
    rs = records(spark, "metrics", [(0, {"route": "/a", "pod": "1", "empty": ""}, 1, "x"), (1, {"route": "/b", "pod": "2"}, 1, "x")])
    report = R.drift(rs, ["route", "method"])
    assert {tuple(r) for r in report.collect()} == {("missing", "method", 0), ("unexpected", "pod", 2)}
    assert [r["key"] for r in R.top_unexpected(report).collect()] == ["pod"]
    assert R.drift(rs, ["route", "method"], ignore=["pod"]).where("kind = 'unexpected'").count() == 0
    assert R.drift(rs.where("false"), ["route"]).count() == 0
    R.assert_unique(rs, ["identity"], "twice")
    with pytest.raises(ValueError, match="twice"):
        R.assert_unique(rs.unionByName(rs), ["identity"], "twice")
