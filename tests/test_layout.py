"""The numbered view of detections: one shuffle for numbers and every step by image, unless an image is crowded."""
import datetime as dt

from pyspark.sql import functions as F

from boxloom.operators.overlap import PAIR_LIMIT
from boxloom.plans import registry

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def tables(spark, tmp_path, images):
    rows = [(i, p, i % 11, i % 7 + 1, float(i % 50), float(i), (i % 10) / 10, 0.0, "A", "F", dt.datetime(2024, 1, 1)) for p, n in images.items() for i in range(n)]
    spark.createDataFrame(rows, LINE).write.parquet(str(tmp_path / "lineitem.parquet"))
    return registry.Tables(spark, str(tmp_path))


def test_one_shuffle_by_image(spark, tmp_path):
    t = tables(spark, tmp_path, {1: 20, 2: 9, None: 3})
    assert not t.crowded
    last = t.detections.groupBy("image_id").agg(F.max("seq").alias("n"))
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sorted((r.image_id or 0, r.n) for r in last.collect()) == [(0, 1), (1, 3), (2, 2)]


def test_crowded_image_is_not_laid_out_by_image(spark, tmp_path):
    t = tables(spark, tmp_path, {1: PAIR_LIMIT + 1, 2: 2})
    assert t.crowded
    assert t.detections.count() == PAIR_LIMIT + 3
    assert "REPARTITION_BY_COL" not in t.detections._jdf.queryExecution().executedPlan().toString()


def test_few_bytes_are_laid_out_over_all_tasks(spark, tmp_path):
    """The steps by image that follow, some of which make thousands of rows of one, run in the tasks of the layout."""
    t = tables(spark, tmp_path, {i: 3 for i in range(200)})
    made = t.detections.select(F.spark_partition_id().alias("p"), "image_id")
    assert made.select("p").distinct().count() == 4
    assert made.groupBy("image_id").agg(F.count_distinct("p").alias("n")).where("n > 1").isEmpty()
    assert made.count() == 600


def test_encoded_words_of_one_run_and_of_many(spark):
    """Sixty-pixel words that are full, empty between, hold one run, or several; each against a plain loop."""
    from boxloom.operators import masks

    sets = {1: range(0, 180), 2: [0, 59, 60, 119, 120], 3: range(1, 60, 2), 4: [59, 60], 5: [7], 6: list(range(10, 70)) + [75, 76, 118], 7: range(60, 120)}
    px = [(k, 30, 6, p // 30, p % 30) for k, ps in sets.items() for p in ps]
    got = {r.image_id: list(r.segmentation.counts) for r in masks.encode(spark.createDataFrame(px + px[:9], "image_id long, h int, w int, x int, y int"), ["image_id"]).collect()}
    for k, ps in sets.items():
        bits = [int(p in set(ps)) for p in range(180)]
        want, last = [0], 0
        for b in bits:
            if b != last:
                want.append(0)
                last = b
            want[-1] += 1
        assert got[k] == want, k
