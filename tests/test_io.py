"""Reading and writing files in the accepted formats."""
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.sources import corpora, discover, predictions


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text) if isinstance(text, bytes) else path.write_text(text)


def test_predictions(spark, tmp_path):
    det = [{"bbox": [1, 2, 3, 4], "score": 0.5, "label": "cat", "sam_mask": {"size": [1, 1], "counts": "x"}},
           {"bbox": [1, 2, 3], "score": 0.5, "label": "short"}, {"bbox": [5, 6, 7, 8], "score": 0.25, "description": "a red cat"}]
    put(tmp_path / "m1" / "a.json", json.dumps(det))
    put(tmp_path / "m1" / "b.v2.json", json.dumps({"b.v2.jpg": {"m1": det}}))
    put(tmp_path / "m1" / "c.json", json.dumps({"c.png": det}))
    put(tmp_path / "m1" / "d e.json", json.dumps({"m1": det}))
    put(tmp_path / "m1" / "bad.json", json.dumps(det)[:-4])
    put(tmp_path / "ram" / "a.json", json.dumps({"a.jpg": {"ram": {"tags": ["x", "y"], "scores": [1.0, 0.5]}}}))
    put(tmp_path / "llava" / "a.json", json.dumps({"a.jpg": {"llava": "A cat."}}))
    put(tmp_path / "llava" / "b.json", json.dumps({"b.jpg": {"llava": {"llava": "A dog."}}}))
    put(tmp_path / "landmark" / "a.json", json.dumps({"a.jpg": {"landmark": {"category": "Outdoor", "fine_category": "Field"}}}))
    put(tmp_path / "landmark" / "b.json", json.dumps({"b.jpg": {"landmark": []}}))
    docs = predictions.payload(predictions.read_documents(spark, str(tmp_path))).cache()
    rows = predictions.detections(docs.where("model = 'm1'")).collect()
    assert {r.image_id for r in rows} == {"a", "b.v2", "c", "d e"} and len(rows) == 8
    assert {(r.seq, r.x1, r.y2, r.label) for r in rows} == {(0, 1.0, 4.0, "cat"), (2, 5.0, 8.0, "a red cat")}
    assert [tuple(r) for r in predictions.unreadable(docs).collect()] == [("bad", "m1")]
    tags = predictions.tags(docs.where("model = 'ram'")).collect()
    assert [(r.pos, r.tag, r.score) for r in tags] == [(0, "x", 1.0), (1, "y", 0.5)]
    assert {r.image_id: r.caption for r in predictions.captions(docs.where("model = 'llava'")).collect()} == {"a": "A cat.", "b": "A dog."}
    scenes = {r.image_id: r.landmark for r in predictions.scenes(docs.where("model = 'landmark'")).collect()}
    assert scenes["a"].fine_category == "Field" and scenes["b"] is None


def test_discover(spark, tmp_path):
    for p in ("det/images/a.jpg", "det/notes/b.jpg", "cls/wheat/c.JPG", "cls/rye/d.jpeg", "cls/e.jpg", "flat/f.png", "flat/g.txt", "skip/h.jpg"):
        put(tmp_path / "data" / p, b"x" * 3)
    found = discover.discover_images(discover.list_files(spark, str(tmp_path / "data")), str(tmp_path / "data"), ignore=["skip"])
    assert {(r.dataset, r.layout, r.class_name, r.image_id) for r in found.collect()} == {
        ("det", "detection", None, "a"), ("cls", "classification", "wheat", "c"), ("cls", "classification", "rye", "d"), ("flat", "flat", None, "f")}


def test_coco_file(spark, tmp_path):
    doc = {"images": [{"id": 7, "file_name": "a.jpg", "width": 10, "height": 20}],
           "annotations": [{"id": 1, "image_id": 7, "category_id": 30, "bbox": [1, 2, 3, 4], "area": 12, "iscrowd": 0, "segmentation": [[1, 1, 2, 2], [0, 0, 1, 0, 1, 1]]},
                           {"id": 2, "image_id": 7, "category_id": 10, "bbox": [0, 0, 5, 5], "area": 25, "segmentation": [[1, 1, 2, 2]]},
                           {"id": 3, "image_id": 7, "category_id": 10, "bbox": [0, 0, 5, 5], "area": 25, "iscrowd": 1, "segmentation": {"size": [20, 10], "counts": [5, 195]},
                            "keypoints": [1, 2, 2]}],
           "categories": [{"id": 30, "name": "dog"}, {"id": 10, "name": "cat"}]}
    put(tmp_path / "c.json", json.dumps(doc))
    parts = corpora.read_coco(spark, str(tmp_path / "c.json"))
    rows = {r.ann_id: r for r in parts["annotations"].collect()}
    assert set(rows) == {1, 3} and rows[1].class_index == 1 and (rows[1].x2, rows[1].y2) == (4.0, 6.0) and len(rows[1].polygons) == 1
    assert rows[3].keypoints == [1.5, 2.5, 2.0] and rows[3].iscrowd == 1
    anns = parts["annotations"].withColumn("seq", F.col("ann_id"))
    corpora.write_coco(parts["images"], anns, parts["categories"], str(tmp_path / "out"))
    back = corpora.read_coco_parts(spark, str(tmp_path / "out"))
    assert [(r.ann_id, r.x1, r.y2, r.area) for r in back["annotations"].orderBy("ann_id").collect()] == [(1, 1.0, 6.0, 12.0), (2, 0.0, 5.0, 25.0)]


def test_voc_and_yolo(spark, tmp_path):
    put(tmp_path / "voc" / "a.xml", "<annotation><filename>a.jpg</filename><object><name>cat</name><difficult>1</difficult><bndbox><xmin>11</xmin><ymin>21</ymin>"
        "<xmax>30</xmax><ymax>40</ymax></bndbox></object></annotation>")
    r = corpora.read_voc(spark, str(tmp_path / "voc")).first()
    assert (r.image_id, r.label, r.difficult, r.x1, r.y1, r.x2, r.y2) == ("a", "cat", True, 10.0, 20.0, 30.0, 40.0)
    put(tmp_path / "yolo" / "a.txt", "0 0.5 0.5 0.2 0.4\n1 0.1\n2 0.25 0.25 0.5 0.5 extra\n")
    images = spark.createDataFrame([("a", 100, 50)], "image_id string, width int, height int")
    rows = corpora.read_yolo(spark, str(tmp_path / "yolo"), images).orderBy("line_no").collect()
    assert [(r.class_index, round(r.x1, 6), round(r.y1, 6), round(r.x2, 6), round(r.y2, 6)) for r in rows] == [(0, 40.0, 15.0, 60.0, 35.0), (2, 0.0, 0.0, 50.0, 25.0)]


def test_yolo_keeps_every_box(spark, tmp_path):
    put(tmp_path / "yolo" / "a.txt", "0 0.5 0.5 0.2 0.4\n" * 150)
    images = spark.createDataFrame([("a", 100, 50)], "image_id string, width int, height int")
    assert corpora.read_yolo(spark, str(tmp_path / "yolo"), images).count() == 150
    assert corpora.read_yolo(spark, str(tmp_path / "yolo"), images, 100).count() == 100


def test_every_image_type_is_found(spark, tmp_path):
    for kind in ("jpg", "JPEG", "png", "bmp", "tif", "tiff", "webp", "txt"):
        put(tmp_path / "all" / "flat" / f"{kind.lower()}.{kind}", "x")
    found = discover.discover_images(discover.list_files(spark, str(tmp_path / "all")), str(tmp_path / "all"))
    assert found.count() == 7


def test_depth_files(spark, tmp_path):
    level = np.array([[0, 51], [102, 255]], dtype=np.uint8)
    put(tmp_path / "img.png_min_-10.0_max_41.0.jpg", level.tobytes())
    put(tmp_path / "plain.jpg", b"1234")
    d = predictions.read_depth(spark, str(tmp_path), lambda b: np.frombuffer(b, dtype=np.uint8).reshape(2, 2))
    assert {(r.image_id, r.x, r.y): round(r.value, 6) for r in d.collect()} == {
        ("img", 0, 0): -10.0, ("img", 1, 0): 0.2, ("img", 0, 1): 10.4, ("img", 1, 1): 41.0}


def test_documents_are_split_and_written(spark, tmp_path):
    objs = spark.range(25).select(F.lit("a").alias("image_id"), F.when(F.col("id") < 20, "object").otherwise("floating").alias("kind"), F.col("id").cast("int"))
    images = spark.createDataFrame([("a", "ds"), ("b", "ds")], "image_id string, dataset string")
    docs = predictions.documents(images, objs, part=10)
    for as_json, name in ((False, "p"), (True, "j")):
        predictions.write_annotations(docs, str(tmp_path / name), as_json)
    back = spark.read.parquet(str(tmp_path / "p"))
    got = {(r.image_id, r.part): (len(r.objects or []), len(r.floating_objects or [])) for r in back.collect()}
    assert got == {("a", 0): (10, 0), ("a", 1): (10, 0), ("a", 2): (0, 5), ("b", 0): (0, 0)}
    assert spark.read.json(str(tmp_path / "j")).count() == 4


def test_dedup_outputs(spark):
    rows = [("f", "a.jpg_min_1.0_max_2.0.jpg", "2024-01-01", 5), ("f", "a.jpg_min_1.5_max_2.0.jpg", "2024-01-02", 9), ("f", "a.png", "2023-01-01", 50), ("f", "b.jpg", "2024-01-01", 1)]
    files = spark.createDataFrame(rows, "folder string, file_name string, m string, size long").withColumn("modified", F.to_timestamp("m"))
    for keep, name in (("newest", rows[1][1]), ("oldest", "a.png"), ("largest", "a.png")):
        plan = discover.dedup_outputs(files, keep)
        assert {r.file_name for r in plan.where("keep").collect()} == {name, "b.jpg"}
    assert discover.duplicate_report(discover.dedup_outputs(files)).first()[1:] == (1, 2, 55)


def test_class_lists(spark):
    a = corpora.class_names(spark, ["x", "y"])
    b = corpora.class_names(spark, {0: "x", 1: "z"})
    df = spark.range(2)
    assert corpora.concat_corpora([(df, a), (df, corpora.class_names(spark, {1: "y", 0: "x"}))]).count() == 4
    with pytest.raises(ValueError):
        corpora.concat_corpora([(df, a), (df, b)])


def test_completion_log(spark, tmp_path):
    """A repeated batch adds nothing, also after it was killed between its parts; later batches add what is new."""
    path = str(tmp_path / "log")
    images = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(9)] + [(9, "d")], "image_id long, dataset string")
    runs = spark.createDataFrame([("a", 5, True, 2, 0.5), ("a", 7, False, None, 0.5), ("b", 9, True, 1, None)], "dataset string, at int, success boolean, masks int, seconds double"
                                 ).withColumn("ts", F.timestamp_seconds("at"))
    report = lambda todo: discover.completion_report(images, images.where(todo), by="dataset")
    seen = lambda: sorted((r.dataset, r.total, r.processed, r.failed, r.masks, r.seconds, r.per_second, r.batch) for r in spark.read.schema(discover.COMPLETION).parquet(path).collect())
    discover.log_completions(report("dataset <> 'a'"), runs, path, 4)
    first = [("a", 3, 1, 1, 2, 1.0, 1.0, 4)]
    assert seen() == first
    discover.log_completions(report("dataset <> 'a'"), runs, path, 4)
    assert seen() == first
    # killed after files of its try were written, before they were committed
    put(tmp_path / "log" / ".spark-staging-x" / "batch=5" / "part-0.parquet", b"cut off")
    for _ in range(2):
        discover.log_completions(report("dataset = 'c'"), runs, path, 5)
    assert seen() == [*first, ("b", 3, 1, 0, 1, 0.0, None, 5), ("d", 1, 0, 0, 0, None, None, 5)]
