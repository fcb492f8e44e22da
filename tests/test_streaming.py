from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from bucketloom.model import HOUR_1, RAW, SPECS
from bucketloom.operators.rollup import rollup
from bucketloom.sinks import parquet
from bucketloom.streaming import rollup as S

T0 = datetime(2026, 8, 27, 10, tzinfo=UTC)


def put(spark, path, minutes, tag):
    rows = [("metrics", T0 + timedelta(minutes=m), {"route": "/a"}, float(m % 37), f"{tag}{m:05d}", "hits_total") for m in minutes]
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(path)


def test_closed_buckets_equal_the_batch_and_late_records_are_dropped(spark, tmp_path):
    src, root, ck = (str(tmp_path / x) for x in ("src", "archive", "ck"))
    go = lambda: S.start(spark.readStream.schema(RAW).parquet(src), SPECS["metrics"], HOUR_1, root, ck).awaitTermination()
    put(spark, src, range(0, 200), "a")
    go()
    got = parquet.read(spark, root)
    assert got.count() == 3  # the last bucket is open: its end lies beyond the watermark
    batch = rollup(spark.read.schema(RAW).parquet(src), SPECS["metrics"], HOUR_1).where(F.col("bucket_start") < T0 + timedelta(hours=3))
    cols = ["bucket_start", "metric", "count", "sum", "min", "max", "first", "last", "delta", "dimension_hash"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    put(spark, src, [5], "late")
    put(spark, src, range(200, 300), "b")
    go()
    assert parquet.read(spark, root).where(F.col("bucket_start") == T0).first()["count"] == 60
    assert parquet.read(spark, root).count() == 4
