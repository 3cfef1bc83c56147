"""Annotation corpora in common exchange formats, as flat tables.

``images(image_id, file_name, width, height)``, ``annotations(ann_id, image_id, category_id, box, ...)``,
``categories(category_id, name)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import boxes as B
from boxloom.functions import text as T

COCO = ("images array<struct<id:bigint,file_name:string,coco_url:string,width:int,height:int,"
        "neg_category_ids:array<int>,not_exhaustive_category_ids:array<int>>>,"
        "annotations array<struct<id:bigint,image_id:bigint,category_id:int,bbox:array<double>,area:double,iscrowd:int,"
        "segmentation:string,keypoints:array<double>>>,"
        "categories array<struct<id:int,name:string,frequency:string>>")
BOX = ["x1", "y1", "x2", "y2"]


def _coco_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three lists of one or many documents; classes may be repeated in each of them."""
    images, anns, cats = (documents.select(F.explode(part).alias("r")).select("r.*")
                          for part in ("images", "annotations", "categories"))
    return images, anns, cats.distinct()


def _read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COCO).option("multiLine", True).json(path)


def from_text(documents: DataFrame) -> DataFrame:
    """Documents held as JSON text in a column ``text``."""
    return documents.select(F.from_json("text", COCO).alias("d")).select("d.*")


def dense_categories(categories: DataFrame) -> DataFrame:
    """Contiguous class indexes from 0, in order of category id."""
    ids = scale.running(categories.select("category_id").where("category_id is not null").distinct(), [], [F.col("category_id")], number="_n")
    return categories.join(ids, "category_id").select(*categories.columns, (F.col("_n") - 1).cast("int").alias("class_index"))


def clean_annotations(annotations: DataFrame) -> DataFrame:
    """Polygons with fewer than three points leave, as do instances left without one; keypoints move to pixel
    centers.  ``segmentation`` is JSON text: a list of polygons, or run lengths."""
    polygons = F.from_json("segmentation", "array<array<double>>")
    good = F.filter(polygons, lambda p: (F.size(p) % 2 == 0) & (F.size(p) >= 6))
    has = F.ltrim("segmentation").startswith("[")
    moved = F.transform("keypoints", lambda v, i: F.when(i % 3 != 2, v + 0.5).otherwise(v))
    return (annotations.withColumn("polygons", F.when(has, good))
            .where(F.col("segmentation").isNull() | ~has | (F.size("polygons") > 0))
            .withColumn("keypoints", moved))


def repeated_ids(annotations: DataFrame, key: str = "ann_id") -> DataFrame:
    """Annotation ids that occur more than once (a corpus should have none)."""
    return annotations.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def read_coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return parse_coco(_read_json(spark, path))


def parse_coco(documents: DataFrame) -> dict[str, DataFrame]:
    images, anns, cats = _coco_tables(documents)
    cats = dense_categories(cats.select(F.col("id").alias("category_id"), "name", "frequency"))
    box = B.from_xywh(*[F.col("bbox")[i] for i in range(4)])
    flat = anns.select(F.col("id").alias("ann_id"), "image_id", "category_id", *[getattr(box, c).alias(c) for c in BOX],
                       "area", F.coalesce("iscrowd", F.lit(0)).alias("iscrowd"), "segmentation", "keypoints")
    return {"images": images.select(F.col("id").alias("image_id"), "file_name", "width", "height"),
            "annotations": clean_annotations(flat).join(scale.maybe_broadcast(cats.select("category_id", "class_index")), "category_id"),
            "categories": cats}


def read_lvis(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return parse_lvis(_read_json(spark, path))


def parse_lvis(documents: DataFrame) -> dict[str, DataFrame]:
    """As ``parse_coco`` with ids from 0, file names from the last two parts of the URL, and the classes known to
    be absent, or not fully annotated, per image."""
    images, anns, cats = _coco_tables(documents)
    parts = F.split("coco_url", "/")
    name = F.coalesce("file_name", F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)))
    box = B.from_xywh(*[F.col("bbox")[i] for i in range(4)])
    listed = lambda c: images.select(F.col("id").alias("image_id"), F.explode(F.transform(c, lambda i: i - 1)).alias("class_index"))
    flat = anns.select(F.col("id").alias("ann_id"), "image_id", "category_id", *[getattr(box, c).alias(c) for c in BOX],
                       "area", F.lit(0).alias("iscrowd"), "segmentation", "keypoints",
                       (F.col("category_id") - 1).alias("class_index"))
    return {"images": images.select(F.col("id").alias("image_id"), name.alias("file_name"), "width", "height"),
            "annotations": clean_annotations(flat),
            "categories": cats.select(F.col("id").alias("category_id"), "name", "frequency", (F.col("id") - 1).alias("class_index")),
            "negative": listed("neg_category_ids"), "not_exhaustive": listed("not_exhaustive_category_ids")}


def coco_annotations(annotations: DataFrame) -> DataFrame:
    """Annotation rows in exchange form: ids from 1 in (image, order) order, boxes as x, y, w, h to three
    decimals, area and crowd flag."""
    x, y, w, h = B.to_xywh(B.cols())
    numbered = scale.running(annotations, [], [F.col("image_id"), F.col("seq")], number="id")
    area = F.coalesce("area", B.area(B.cols())) if "area" in annotations.columns else B.area(B.cols())
    crowd = F.coalesce("iscrowd", F.lit(0)) if "iscrowd" in annotations.columns else F.lit(0)
    return numbered.select("id", "image_id", "category_id", *[F.round(v, 3).alias(n) for n, v in zip("xywh", (x, y, w, h))],
                           F.round(area, 3).alias("area"), crowd.cast("int").alias("iscrowd"))


def write_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """One folder of JSON lines per table.  A corpus of this size does not fit one JSON document, so the three
    lists stay separate files; ``read_coco_parts`` reads them back."""
    rows = coco_annotations(annotations).select("id", "image_id", "category_id", F.array(*"xywh").alias("bbox"), "area", "iscrowd")
    images.select(F.col("image_id").alias("id"), "file_name", "width", "height").write.json(f"{path}/images")
    rows.write.json(f"{path}/annotations")
    categories.select(F.col("category_id").alias("id"), "name").write.json(f"{path}/categories")


def read_coco_parts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    i = spark.read.schema("id bigint, file_name string, width int, height int").json(f"{path}/images")
    a = spark.read.schema("id bigint, image_id bigint, category_id int, bbox array<double>, area double, iscrowd int").json(f"{path}/annotations")
    c = spark.read.schema("id int, name string").json(f"{path}/categories")
    box = B.from_xywh(*[F.col("bbox")[k] for k in range(4)])
    return {"images": i.withColumnRenamed("id", "image_id"),
            "annotations": a.select(F.col("id").alias("ann_id"), "image_id", "category_id",
                                    *[getattr(box, n).alias(n) for n in BOX], "area", "iscrowd"),
            "categories": c.withColumnRenamed("id", "category_id")}


def coco_results(pred: DataFrame) -> DataFrame:
    """Detections in the exchange form for results: ``image_id, category_id, bbox, score``."""
    x, y, w, h = B.to_xywh(B.cols())
    return pred.select("image_id", "category_id", F.array(x, y, w, h).alias("bbox"), "score")


VOC = ("struct<filename:string,object:array<struct<name:string,difficult:int,"
       "bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>>")


def read_voc(spark: SparkSession, path: str) -> DataFrame:
    return parse_voc(spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(
        F.col("value").alias("text")))


def parse_voc(documents: DataFrame) -> DataFrame:
    """``image_id, label, gt, difficult, box`` from one XML text per image; corners count from 0."""
    rows = documents.select(F.from_xml("text", VOC).alias("a")).select("a.*")
    image = F.regexp_replace("filename", r"\.[^.]+$", "")
    return rows.select(image.alias("image_id"), F.posexplode("object").alias("gt", "o")).select(
        "image_id", F.col("o.name").alias("label"), "gt", (F.coalesce("o.difficult", F.lit(0)) == 1).alias("difficult"),
        (F.col("o.bndbox.xmin") - 1).alias("x1"), (F.col("o.bndbox.ymin") - 1).alias("y1"),
        F.col("o.bndbox.xmax").alias("x2"), F.col("o.bndbox.ymax").alias("y2"))


def parse_yolo(lines: DataFrame, images: DataFrame, limit: int | None = None) -> DataFrame:
    """Boxes from ``class cx cy w h`` lines in shares of the image; lines with fewer than five fields are
    skipped.  All boxes come; ``limit`` keeps the first boxes of each image instead.
    ``lines(image_id, line_no, line)``."""
    f = F.split(T.strip(F.col("line")), r"\s+")
    num = lambda i: f[i].cast("double")
    good = lines.where(F.size(f) >= 5)
    if limit is not None:
        rn = F.row_number().over(Window.partitionBy("image_id").orderBy("line_no"))
        good = good.withColumn("_rn", rn).where(F.col("_rn") <= limit).drop("_rn")
    sized = good.join(images.select("image_id", "width", "height"), "image_id")
    box = B.from_cxcywh(num(1), num(2), num(3), num(4), F.col("width"), F.col("height"))
    return sized.select("image_id", "line_no", f[0].cast("int").alias("class_index"), *[getattr(box, c).alias(c) for c in BOX])


def read_yolo(spark: SparkSession, path: str, images: DataFrame, limit: int | None = None) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    name = F.regexp_replace(F.url_decode(F.element_at(F.split("_metadata.file_path", "/"), -1)), r"\.[^.]+$", "")
    lines = text.select(name.alias("image_id"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return parse_yolo(lines, images, limit)


def numbered_names(names: DataFrame, name: str = "name") -> DataFrame:
    """``class_index, name``: the distinct names in order, from 0; a list of any length, none of it through the driver."""
    every = names.select(F.col(name).alias("name")).where("name is not null").distinct()
    return scale.running(every, [], [F.col("name")], number="_n").select((F.col("_n") - 1).cast("int").alias("class_index"), "name")


def class_names(spark: SparkSession, names: list | dict) -> DataFrame:
    """Class names given as a list, or as index to name."""
    pairs = names.items() if isinstance(names, dict) else enumerate(names)
    return spark.createDataFrame([(int(i), str(n)) for i, n in pairs], "class_index int, name string")


def concat_corpora(parts: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Annotations of several corpora as one, refused when their class lists differ."""
    (first, classes), *rest = parts
    out = first
    for df, other in rest:
        if not classes.exceptAll(other).isEmpty() or not other.exceptAll(classes).isEmpty():
            raise ValueError("class lists of the corpora differ")
        out = out.unionByName(df)
    return out
