"""Trackers against a frame-by-frame loop, in batch and on a stream."""
import random

import pytest
from helpers import groups, iou
from pyspark.sql import functions as F

from boxloom.streaming import track

S = "video_id long, frame int, idx int, x1 double, y1 double, x2 double, y2 double"


def make(seed, videos=3, frames=8):
    r = random.Random(seed)
    rows = []
    for v in range(videos):
        spots = [(r.randrange(100), r.randrange(100)) for _ in range(5)]
        for f in range(frames):
            here = [s for s in spots if r.random() < 0.7]
            r.shuffle(here)
            for i, (x, y) in enumerate(here):
                j = r.randrange(-6, 7)
                rows.append((v, f * 3, i, float(x + j), float(y + j), float(x + j + 30), float(y + j + 30)))
    return rows


def walk(rows, t=0.5, max_lost=0, min_period=1, min_size=0.02, w=200, h=200, best_first=False):
    out = {}
    for v, mine in groups(rows, lambda r: r[0]).items():
        memory, count = [], 0
        for f, now in sorted(groups(mine, lambda r: r[1]).items()):
            now = sorted(now, key=lambda r: r[2])
            pairs = [(iou(n[3:], m["box"]), i, j) for i, n in enumerate(now) for j, m in enumerate(memory)]
            if best_first:
                pairs.sort(key=lambda p: (-p[0], p[1], p[2]))
            got, used = {}, set()
            for v_, i, j in pairs:
                if v_ >= t and i not in got and j not in used:
                    got[i] = j
                    used.add(j)
            new = []
            for i, n in enumerate(now):
                if i in got:
                    m = memory[got[i]]
                    new.append({"box": n[3:], "id": m["id"], "period": m["period"] + 1, "lost": 0})
                else:
                    new.append({"box": n[3:], "id": count, "period": 1, "lost": 0})
                    count += 1
                out[(v, f, n[2])] = (new[-1]["id"], new[-1]["period"])
            for j, m in enumerate(memory):
                big = (m["box"][2] - m["box"][0]) / w >= min_size and (m["box"][3] - m["box"][1]) / h >= min_size
                if j not in used and big and m["lost"] < max_lost and m["period"] > min_period:
                    new.append({**m, "lost": m["lost"] + 1})
            memory = new
    return out


def result(df):
    return {(r.video_id, r.frame, r.idx): (r.track_id, r.period) for r in df.collect()}


@pytest.mark.parametrize("best_first", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_frames(spark, hot, best_first):
    rows = make(1)
    assert result(track.track_frames(spark.createDataFrame(rows, S), best_first=best_first, hot=hot)) == walk(rows, best_first=best_first)


@pytest.mark.parametrize("max_lost", [0, 2])
def test_memory(spark, max_lost):
    rows = make(2)
    got = track.track_with_memory(spark.createDataFrame(rows, S), max_lost, width=200, height=200)
    assert result(got) == walk(rows, max_lost=max_lost)


@pytest.mark.parametrize("options", [{"min_period": 3}, {"min_period": 0, "min_size": 0.16}, {"best_first": True, "min_period": 2, "iou": 0.3}])
def test_memory_options(spark, options):
    rows = make(6, videos=2, frames=14)
    got = track.track_with_memory(spark.createDataFrame(rows, S), 3, width=200, height=200, **options)
    names = {"t": options.get("iou", 0.5), **{k: v for k, v in options.items() if k != "iou"}}
    assert result(got) == walk(rows, max_lost=3, **names)


def test_memory_spreads_one_video(spark):
    """One long video with objects that leave and return: few rounds, rows over all tasks, as in the walk."""
    r = random.Random(9)
    spots = [(r.randrange(4000), r.randrange(4000)) for _ in range(6)]
    rows = [(1, f, i, float(x), float(y), float(x + 100), float(y + 100)) for f in range(600)
            for i, (x, y) in enumerate(s for s in spots if r.random() < 0.8)]
    rounds = []
    old = track.scale.checkpointed
    track.scale.checkpointed = lambda df: rounds.append(1) or old(df)
    try:
        got = track.track_with_memory(spark.createDataFrame(rows, S).repartition(4), 2, width=4100, height=4100)
    finally:
        track.scale.checkpointed = old
    assert len(rounds) < 40
    assert result(got) == walk(rows, max_lost=2, w=4100, h=4100)
    laid = track._possible(got.withColumn("f", F.col("frame")), 1, 0.5, 0.0, 1, 1, False, False)
    assert laid.groupBy(F.spark_partition_id().alias("p")).count().where("count > 0").count() > 1


def test_memory_across_batches(spark):
    """A video, and a frame of it, spread over many Arrow batches."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = make(3)
        assert result(track.track_with_memory(spark.createDataFrame(rows, S), 2, width=200, height=200)) == walk(rows, max_lost=2)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_order_swap(spark):
    """Two boxes that change places between frames keep their ids."""
    rows = [(0, 1, 0, 101.0, 101.0, 200.0, 200.0), (0, 1, 1, 301.0, 301.0, 450.0, 450.0),
            (0, 2, 0, 302.0, 303.0, 451.0, 452.0), (0, 2, 1, 101.0, 102.0, 201.0, 203.0)]
    got = result(track.track_frames(spark.createDataFrame(rows, S)))
    assert [got[(0, 2, i)][0] for i in (0, 1)] == [1, 0]


def test_stream(spark, tmp_path):
    """Files of later frames arrive one by one; a file of old frames is late and dropped."""
    rows = make(4)
    src, n = tmp_path / "in", 0
    src.mkdir()

    def feed(part):
        nonlocal n
        spark.createDataFrame(part, S).coalesce(1).write.parquet(str(src / f"b{n}"))
        n += 1

    feed([r for r in rows if r[1] < 9])
    stream = spark.readStream.schema(S).parquet(f"{src}/*")
    q = (track.track_stream(stream, max_lost=2, width=200, height=200).writeStream.format("memory").queryName("tracked")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start())
    try:
        q.processAllAvailable()
        feed([r for r in rows if r[1] >= 9])
        q.processAllAvailable()
        feed([r for r in rows if r[1] < 9][:5])
        q.processAllAvailable()
        assert result(spark.table("tracked")) == walk(rows, max_lost=2)
    finally:
        q.stop()


def test_stream_with_event_time(spark, tmp_path):
    """With times the state of a silent video ends; a video that returns later starts anew."""
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    row = lambda v, f, m: (v, f, 0, 0.0, 0.0, 50.0, 50.0, at(m))
    src = tmp_path / "in"
    src.mkdir()
    schema = S + ", ts timestamp"
    stream = spark.readStream.schema(schema).parquet(f"{src}/*")
    q = (track.track_stream(stream, width=200, height=200, lateness="1 minute").writeStream.format("memory").queryName("timed")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start())
    try:
        for i, part in enumerate([[row(1, 1, 0), row(2, 1, 0)], [row(2, 2, 1)], [row(2, 3, 60)], [row(2, 4, 61)], [row(1, 2, 62), row(2, 5, 62)]]):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(src / f"b{i}"))
            q.processAllAvailable()
        got = result(spark.table("timed"))
        assert got[(1, 1, 0)] == (0, 1) and got[(1, 2, 0)] == (0, 1)      # forgotten in between
        assert [got[(2, f, 0)][0] for f in (1, 2)] == [0, 0] and got[(2, 5, 0)][1] >= 2
    finally:
        q.stop()
