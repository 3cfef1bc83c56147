"""Medians of depth in boxes against all pixels of each box."""
import random
import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from boxloom.operators import merge

OBJECTS = "image_id long, id int, x1 double, y1 double, x2 double, y2 double"
DEPTH = "image_id long, x int, y int, value double"


def made(seed, images=3, width=90, height=70):
    r = random.Random(seed)
    depth, boxes = [], []
    for i in range(images):
        pool = [round(r.random() * 50, 2) for _ in range(3 if i == 0 else 4000)]
        depth += [(i, x, y, 0.0 if r.random() < 0.1 else r.choice(pool)) for x in range(width) for y in range(height) if r.random() < 0.8]
        for k in range(40):
            x, y = r.uniform(-20, width), r.uniform(-20, height)
            boxes.append((i, k, x, y, x + r.choice([0.5, 3, 20, 60, 200]), y + r.choice([0.5, 3, 20, 60, 200])))
        boxes += [(i, 100, -5.0, -5.0, 1e6, 1e6), (i, 101, 32.0, 32.0, 64.0, 64.0), (i, 102, 32.0, 32.0, 64.0, 64.0), (i, 103, 5.0, 5.0, 4.0, 9.0)]
    boxes.append((99, 1, 0.0, 0.0, 10.0, 10.0))
    return boxes, depth


def brute(boxes, depth, width=None, height=None):
    out = {}
    for i, k, x1, y1, x2, y2 in boxes:
        own = [(x, y, v) for j, x, y, v in depth if j == i]
        w, h = (width or max((x for x, _, _ in own), default=-1) + 1), (height or max((y for _, y, _ in own), default=-1) + 1)
        v = [v for x, y, v in own if v and max(0, int(x1)) <= x < min(w, int(x2)) and max(0, int(y1)) <= y < min(h, int(y2))]
        out[i, k] = float(Decimal(f"{statistics.median(v):.6f}").quantize(Decimal("0.01"), ROUND_HALF_UP)) if v else None
    return out


@pytest.mark.parametrize("cell,bins", [(32, 32), (8, 4)])
@pytest.mark.parametrize("size", [{}, {"width": 80, "height": 100}])
def test_against_all_pixels(spark, cell, bins, size):
    boxes, depth = made(4)
    got = merge.median_depth(spark.createDataFrame(boxes, OBJECTS), spark.createDataFrame(depth, DEPTH), cell=cell, bins=bins, **size)
    assert {(r.image_id, r.id): r.depth for r in got.collect()} == brute(boxes, depth, **size)


def test_a_whole_image_costs_its_tiles(spark):
    depth = spark.range(256 * 256).select(F.lit(1).cast("long").alias("image_id"), (F.col("id") % 256).cast("int").alias("x"), F.expr("cast(id div 256 as int)").alias("y"),
                                          (1 + F.col("id") % 1000).cast("double").alias("value"))
    pixels, cells = merge.depth_cells(depth)
    assert cells.count() <= 64 * 32 and merge.summed_tiles(cells).count() == 64
    assert merge.summed_tiles(cells).where("tx = 7 and ty = 7").select(F.aggregate("sums", F.lit(0).cast("long"), lambda a, n: a + n)).first()[0] == 256 * 256
    whole = spark.createDataFrame([(1, 0, 0, 256, 256, 0, 0, 7, 7)], "image_id long, a int, b int, c int, d int, l long, t long, r long, u long")
    assert merge._rim(whole, pixels, 32).count() == 0
    one = merge.median_depth(spark.createDataFrame([(1, 1, 0.0, 0.0, 256.0, 256.0)], OBJECTS), depth).first().depth
    assert one == float(depth.select(F.percentile("value", F.lit(0.5))).first()[0])


def test_odd_values(spark):
    depth = [(1, 0, 0, None), (1, 1, 0, 2.0), (1, 2, 0, 4.005), (2, 0, 0, 0.0), (None, 0, 0, 3.0)]
    boxes = [(1, 1, 0.0, 0.0, 9.0, 9.0), (2, 1, 0.0, 0.0, 9.0, 9.0), (1, 2, None, 0.0, 9.0, 9.0), (None, 3, 0.0, 0.0, 9.0, 9.0)]
    got = merge.median_depth(spark.createDataFrame(boxes, OBJECTS), spark.createDataFrame(depth, DEPTH)).collect()
    assert sorted((r.image_id or 0, r.id, r.depth) for r in got if r.id != 2) == [(0, 3, None), (1, 1, 3.0), (2, 1, None)]
    assert merge.median_depth(spark.createDataFrame([], OBJECTS), spark.createDataFrame(depth, DEPTH)).count() == 0
    assert [r.depth for r in merge.median_depth(spark.createDataFrame(boxes[:1], OBJECTS), spark.createDataFrame([], DEPTH)).collect()] == [None]


def rows(df):
    return sorted(str(r) for r in df.collect())


@pytest.mark.parametrize("few", [300, 2000])
@pytest.mark.parametrize("size", [{}, {"width": 20, "height": 30}])
def test_few_pixels_are_read_and_many_go_by_tiles(spark, few, size):
    boxes, depth = made(5, images=2, width=15, height=11)
    more, large = made(6, images=1, width=40, height=35)
    boxes, depth = boxes + [(7, *b[1:]) for b in more if b[0] == 0], depth + [(7, *d[1:]) for d in large]
    got = merge.median_depth(spark.createDataFrame(boxes, OBJECTS), spark.createDataFrame(depth, DEPTH), few=few, **size)
    assert {(r.image_id, r.id): r.depth for r in got.collect()} == brute(boxes, depth, **size)


def test_plans_agree_on_repeated_and_missing_ids(spark):
    """Also where ids are shared by boxes of one or of several kinds, or are null."""
    r = random.Random(8)
    depth = spark.createDataFrame([(r.choice([1, 2, 3, None]), r.randrange(12), r.randrange(9), r.choice([0.0, None, 1.5, 2.25, 7.0, float("nan")])) for _ in range(160)], DEPTH)
    boxes = [(r.choice([1, 2, 3, 4, None]), r.choice(["object", "floating", "attribute", None]) if i % 3 else "floating", r.choice([*range(9), None]),
              float(r.randrange(9)), float(r.randrange(7)), float(r.randrange(14)), r.choice([None, 6.0, 9.5])) for i in range(90)]
    objects = spark.createDataFrame([b for b in boxes if not (b[0] == 3 and b[1] == "object")], "image_id long, kind string, id int, x1 double, y1 double, x2 double, y2 double")
    for operator in (merge.median_depth, merge.add_depth):
        tiled = rows(operator(objects, depth, hot=True))
        assert any("depth=None" not in t for t in tiled)
        for hot, few in ((False, 2000), (None, 2000), (None, 35)):
            assert rows(operator(objects, depth, hot=hot, few=few)) == tiled, (hot, few)


def test_few_pixels_need_no_second_pass_over_boxes(spark, tmp_path):
    """The rows of the boxes, which are costly to make, are made once where no image holds many."""
    objects = spark.createDataFrame([(i % 9, "object", i, 0.0, 0.0, 5.0, 5.0) for i in range(40)], "image_id long, kind string, id int, x1 double, y1 double, x2 double, y2 double")
    objects.write.parquet(str(tmp_path / "o"))
    depth = spark.createDataFrame([(i % 9, i % 7, i % 5, float(i)) for i in range(200)], DEPTH)
    for operator in (merge.median_depth, merge.add_depth):
        df = operator(spark.read.parquet(str(tmp_path / "o")), depth, hot=False)
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        assert df.where("depth is not null").count() == 40
