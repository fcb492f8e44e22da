from datetime import datetime

from pyspark.sql import functions as F

from bucketloom import functions as X


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], names) if names else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_buckets_before_the_epoch(spark):
    t = datetime(1969, 12, 31, 23, 59, 59)
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{t}' AS t")
    assert df.select(X.bucket_start(F.col("t"), 3600)).first()[0] == datetime(1969, 12, 31, 23)
    assert df.select(X.floored(F.col("t"), 3600).cast("timestamp_ntz")).first()[0] == datetime(1969, 12, 31, 23)


def test_dimensions(spark):
    df = spark.sql("SELECT map('b', '2', 'a', '1', 'c', '', 'd', CAST(NULL AS STRING)) AS m")
    assert list(df.select(X.canonical(F.col("m"))).first()[0].items()) == [("a", "1"), ("b", "2")]
    assert df.select(X.without(F.col("m"), ["a", "b"])).first()[0] == {"c": "", "d": None}
    row = df.select(*[X.retained(F.col("m"), k, "x") for k in "acde"], X.retained(F.col("m"), "c")).first()
    assert list(row) == ["1", "x", "x", "x", None]


def test_hashes_ignore_key_order_and_tell_null_from_empty(spark):
    a, b = (spark.sql(f"SELECT map({x}) AS m").select(X.dimension_hash(F.lit("n"), X.canonical(F.col("m")))).first()[0] for x in ("'a','1','b','2'", "'b','2','a','1'"))
    assert a == b
    assert one(spark, X.identity(F.lit(None), F.lit("x"))) != one(spark, X.identity(F.lit(""), F.lit("x")))


def test_nanoseconds_are_cut_exactly(spark):
    assert one(spark, F.unix_micros(X.from_nanos(F.lit("1787824800123456789")))) == 1787824800123456


def test_severity_and_positive_int(spark):
    df = spark.createDataFrame([(x,) for x in ["", " ", "UNKNOWN", "unspecified", "None", None]], "s string")
    assert {r[0] for r in df.select(X.folded_severity(F.col("s"))).collect()} == {"unknown"}
    assert one(spark, X.folded_severity(F.lit(" ErrOr "))) == "error"
    assert [one(spark, X.positive_int(F.lit(x))) for x in ("20", "0", "-3", "x", None)] == [20, 1, 1, 1, 1]


def test_durations(spark):
    given = ["3d", "72h", "2160h", "30m", "1w", "1.5h", "", "forever", "3", "d", "3 days", None]
    df = spark.createDataFrame([(x,) for x in given], "s string").select(X.duration_seconds(F.col("s")).alias("x"))
    assert [r.x for r in df.collect()] == [259200, 259200, 7776000, 1800, 604800, 5400, None, None, None, None, None, None]
    assert [one(spark, X.humanised(F.lit(s))) for s in (259200, 7200, 1800)] == ["3d", "2h", "30m"]


def test_labels_are_escaped(spark):
    assert one(spark, X.escaped_label(F.lit('a\\b"c\nd'))) == 'a\\\\b\\"c\\nd'


def test_safety_is_strict_and_unknown_fails(spark):
    args = (F.lit(1200), F.lit(3600), F.lit(7200))
    assert [one(spark, X.is_safe(F.lit(h).cast("long"), *args)) for h in (12000, 12060, None)] == [False, True, False]


def test_range_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:30:00' AS ts, 1 AS v, 'wide' AS other").write.parquet(path)
    df = spark.read.parquet(path).where(X.in_range(F.col("ts"), datetime(2024, 1, 1), datetime(2024, 1, 2))).select("ts")
    assert df.count() == 1
    plan = df._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in plan and "other" not in plan.split("ReadSchema")[1]
