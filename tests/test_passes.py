"""How often the numbered detections are made for one query: each time sorts all of them."""
import datetime as dt

import pytest

from boxloom.plans import registry
from boxloom.plans.queries import load

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    lines = [(i, p, i % 11, i % 7 + 1, float(i % 50), float(i), (i % 10) / 10, 0.0, "A", "F", dt.datetime(2024, 1, 1)) for p in (1, 2, None) for i in range(p or 5) for i in range(i, 40, 2)]
    spark.createDataFrame(lines, LINE).write.parquet(str(at / "lineitem.parquet"))
    parts = [(p, "brand", f"type {p}", 5) for p in (1, 2, 3)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string, p_size int").write.parquet(str(at / "part.parquet"))
    return str(at)


@pytest.mark.parametrize("name,most", [("scene_text", 1), ("relationship_groups", 2), ("filter_groundings", 1), ("ground_dense_fuzzy", 3)])
def test_detections_are_numbered_few_times(spark, folder, name, most):
    load()
    df = registry.QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sum("row_number()" in line for line in plan.splitlines() if "Window [" in line) <= most
    assert df.count() > 0


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    """Phrases and known texts are made once, though an image with many of them is met on another plan than the rest."""
    from pyspark.sql import functions as F
    from boxloom import scale
    from boxloom.operators import ground

    monkeypatch.setattr(scale, "GROUP_LIMIT", 5)
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        made.add(1)
        return text

    ask = spark.createDataFrame([(i % 3 if i < 9 else 1, f"red box {i}", i) for i in range(20)], "image_id long, t string, p int").repartition(2)
    ask = ask.select("image_id", seen.asNondeterministic()("t").alias("phrase"), "p").withColumn("_wp", F.split("phrase", " "))
    known = spark.createDataFrame([(i, "a red box 4", i) for i in range(3)], "image_id long, text string, id int").withColumn("_wt", F.split("text", " "))
    met = ground._meet_each(ask, known).where("size(array_except(_wp, _wt)) = 0")
    assert sorted((r.image_id, r.phrase) for r in met.collect()) == [(1, "red box 4")]
    assert made.value == 20


def test_level_2_counts_boxes_once(spark, monkeypatch):
    """Where no image holds many boxes, none of its steps counts them again."""
    from boxloom import scale
    from boxloom.plans import annotate

    boxes = [(i, k, "object" if k % 2 else "floating", k, 8.0 * k, 0.0, 8.0 * k + 7, 9.0, ["cup"], None, 0.5) for i in (1, 2) for k in range(4)]
    objects = spark.createDataFrame(boxes, "image_id long, seq int, kind string, id int, x1 double, y1 double, x2 double, y2 double, labels array<string>, attributes array<string>, score double")
    phrases = spark.createDataFrame([(1, 1, "the cup", "cup", 8.0, 0.0, 15.0, 9.0), (1, 2, "a new one", "one", 90.0, 0.0, 95.0, 9.0)],
                                    "image_id long, seq int, phrase string, noun string, x1 double, y1 double, x2 double, y2 double")
    images = spark.createDataFrame([(1, 100, 100), (2, 100, 100)], "image_id long, width int, height int")
    whole = annotate.level2(annotate.Level1(objects.drop("seq"), None, False), images, phrases, keep=lambda df: df).objects
    want = sorted(str(r) for r in whole.collect())

    def again(*args):
        raise AssertionError("counted again")

    monkeypatch.setattr(scale, "crowds", again)
    got = annotate.level2(annotate.Level1(objects.drop("seq"), None, False), images, phrases, keep=lambda df: df)
    assert sorted(str(r) for r in got.objects.collect()) == want and len(want) == 9
    assert sorted((r.image_id, r.phrase) for r in got.links.collect()) == [(1, "a new one"), (1, "the cup")]
