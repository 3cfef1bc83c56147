"""Incremental annotation and progress on streams."""
import datetime as dt

from helpers import SCHEMA, random_boxes
from pyspark.sql import functions as F

from boxloom.operators import dedup, vote
from boxloom.streaming import progress


def test_annotate_stream(spark, tmp_path):
    rows = random_boxes(8, images=4, per_image=20)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    work = lambda df: vote.assign_ids(vote.vote(dedup.nms(df)))
    for part in (lambda r: r[0] < 2, lambda r: r[0] >= 2):
        spark.createDataFrame([r for r in rows if part(r)], SCHEMA).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        q = progress.annotate_stream(stream, work, out, str(tmp_path / "cp"))
        q.awaitTermination(120)
        assert q.exception() is None
    got = spark.read.parquet(out)
    want = work(spark.createDataFrame(rows, SCHEMA))
    cols = ["image_id", "kind", "id", "seed_priority", "seed_seq"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)
    assert got.select("batch").distinct().count() == 2


def test_rate_stream(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(t0 + dt.timedelta(seconds=20 * i), "a", i % 5 != 0) for i in range(30)] + [(t0 + dt.timedelta(hours=1), "a", True)]
    spark.createDataFrame(rows, "ts timestamp, dataset string, success boolean").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, dataset string, success boolean").parquet(str(tmp_path / "in"))
    q = (progress.run_rate(stream).writeStream.format("memory").queryName("rates").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "cp")).start())
    try:
        q.processAllAvailable()
        closed = spark.table("rates")
        assert closed.count() == 10 and closed.agg(F.sum("images"), F.sum("failures")).first() == (30, 6)
        assert closed.first().per_second == 3 / 60
    finally:
        q.stop()
